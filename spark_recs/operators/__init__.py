"""Relational and model operators.  Each takes and returns DataFrames."""
