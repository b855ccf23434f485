"""Operators for training data: one module each, and their registered queries."""
