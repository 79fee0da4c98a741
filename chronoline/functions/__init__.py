"""Scalar Column functions: nanosecond time and the line-protocol codec."""
