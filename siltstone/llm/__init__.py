"""Operators that prepare language-model training data, and their queries."""
