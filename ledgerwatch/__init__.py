"""Fraud scoring and model monitoring as Spark DataFrame jobs."""
