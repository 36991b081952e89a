"""Genomics data preparation and evaluation as Spark DataFrame operators."""
