"""Basketry: retail analytics as plain Spark DataFrame functions."""
