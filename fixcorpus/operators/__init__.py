"""Operators over finding tables; every one takes and returns DataFrames."""
