"""Operators over frames: matrix, factors, nearest vectors, ranking."""
