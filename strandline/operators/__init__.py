"""Relational operators on signals, intervals and contacts: each takes and returns DataFrames."""
