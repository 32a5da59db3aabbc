"""Spark-first operators for multilingual UI-string corpora."""
