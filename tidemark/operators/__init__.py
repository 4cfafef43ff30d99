"""Operators on raw, flat and mart rows; each one is a DataFrame in, a DataFrame out."""
