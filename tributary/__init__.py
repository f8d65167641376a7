"""Spark jobs that turn fiscal XML documents into monthly analytic tables."""
