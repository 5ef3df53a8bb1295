"""Readers: the only modules that turn paths into DataFrames."""
