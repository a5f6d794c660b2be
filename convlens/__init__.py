"""Spark operators for labelled conversation corpora."""
