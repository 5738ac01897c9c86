"""Operators of a training-data pipeline, written for Spark; nothing else in the library imports them."""
