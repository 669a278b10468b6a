"""Operators over lines, blocks and holdings: DataFrame in, DataFrame out."""
