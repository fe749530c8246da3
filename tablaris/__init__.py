"""Tabular cleaning and linear-regression analytics as Spark jobs."""
