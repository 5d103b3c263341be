"""Operators for building training data from documents and conversations."""
