"""Composed corpora: whole chains from raw tables to the labelled, split result."""
