"""Operators over observation DataFrames."""
