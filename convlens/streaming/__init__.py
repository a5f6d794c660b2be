"""Scoring of arriving conversations with a fitted model."""
