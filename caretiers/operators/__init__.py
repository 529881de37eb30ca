"""Whole-table operators: cleaning, column replacement, flattening and validation."""
