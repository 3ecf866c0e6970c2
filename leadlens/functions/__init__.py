"""Scalar Column expressions and driver-side distribution functions."""
