"""Derived views, registered queries and multi-operator plans."""
