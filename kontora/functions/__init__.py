"""Scalar and aggregate expressions used across the plans."""
