"""Operators for the preparation of training data. Nothing else in the library imports this subpackage."""
