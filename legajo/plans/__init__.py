"""Derived corpora, whole-folder jobs and the registered queries."""
