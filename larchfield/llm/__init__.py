"""Operators for building training corpora from documents, pages and vectors."""
