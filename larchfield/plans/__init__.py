"""Entity rules, marts and the registered queries, built from the operators."""
