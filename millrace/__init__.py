"""Spark-first analytics over discovered pages, extracted articles and entity histories."""
