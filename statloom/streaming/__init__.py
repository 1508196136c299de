"""Scoring of saved models on batches and streams."""
