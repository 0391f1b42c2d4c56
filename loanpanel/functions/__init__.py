"""Scalar column expressions used by every operator."""
