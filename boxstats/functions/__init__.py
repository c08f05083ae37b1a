"""Scalar functions, constants and record types."""
