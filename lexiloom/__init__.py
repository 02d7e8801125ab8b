"""Spark-first engine for building and evaluating labelled text-moderation corpora."""
