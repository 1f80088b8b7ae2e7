"""Composite plans: the lakehouse models built from the operators."""
