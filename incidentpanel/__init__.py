"""Spatio-temporal incident analytics written as Spark DataFrame functions."""

__version__ = "0.1.0"
