"""File sources, table sinks and their checks."""
