"""Quadrille: semantic-graph analytics as lazy Spark DataFrames."""
