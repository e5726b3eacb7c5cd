"""Operators for preparing training data: one module per operator, one catalog of queries."""
