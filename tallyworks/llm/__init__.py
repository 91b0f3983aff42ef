"""Operators for training-data pipelines: documents and conversations in, tables and files out."""
