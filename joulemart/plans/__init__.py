"""Datasets: staging, star schema, analytics, reports and models."""
