"""Inputs and outputs: monthly raw files, dimensions, exports, test tables."""
