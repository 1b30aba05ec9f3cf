"""Operators for the text side of a training-data pipeline."""
