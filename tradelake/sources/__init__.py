"""Inputs and outputs: the trades table, dimensions, exports."""
