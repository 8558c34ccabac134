"""Operators for building training data sets from large text collections."""
