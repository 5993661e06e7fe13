"""Operators of a training-data pipeline, each with a registered query; nothing else in the library imports this package."""
