"""Loan and economic sources, nested-history construction, staged tables."""
