"""Whole analyses composed of the operators, for all samples at once."""
