"""Operators: ``DataFrame -> DataFrame`` steps that the plans compose."""
