"""Operators for training-data pipelines. Nothing else in ligature imports this subpackage."""
