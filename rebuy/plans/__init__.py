"""Composed jobs: feature table, holdout split, model training and the
query registry used by ``__spark_entry__``."""
