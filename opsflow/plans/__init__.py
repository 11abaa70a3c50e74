"""Bindings of the operators to the driver's tables, and their SQL oracles."""
