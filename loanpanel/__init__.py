"""Loan-performance panels, models and model assessment as Spark jobs."""
