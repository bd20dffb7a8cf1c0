"""Dimension and fact loads put together from the operators, and the two daily flows."""
