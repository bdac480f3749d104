"""Relational operators over decision records and predictions."""
