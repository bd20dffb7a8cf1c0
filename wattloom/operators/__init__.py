"""Relational operators: DataFrames in, DataFrames out. Two run a job of their own: upsampling counts its steps, dense keys write the joined rows once."""
