"""Registered queries over the driver tables, each with its checking SQL."""
