"""Operators for training-data pipelines (text tables), one module each."""
