"""Batch operators: DataFrame in, DataFrame (or a main and a side DataFrame) out."""
