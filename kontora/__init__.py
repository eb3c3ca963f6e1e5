"""Retail-banking analytics and feature engineering as Spark jobs."""
