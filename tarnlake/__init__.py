"""Layered lakehouse jobs as plain Spark DataFrame functions."""
