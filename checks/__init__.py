"""Inputs, queries and SQL oracles that check the package against the test tables."""
