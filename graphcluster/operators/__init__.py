"""Operators: graph views, PIVOT, local search, costs and verifiers."""
