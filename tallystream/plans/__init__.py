"""Bindings of the operators to the test tables, with their SQL oracles."""
