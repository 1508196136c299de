"""Typed readers, generators, and the model store."""
