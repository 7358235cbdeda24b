"""Registered queries: every operator over views of the given tables, with its SQL counterpart."""
