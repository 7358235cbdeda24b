"""Modelled tables and daily jobs, composed of the operators."""
