"""Registered queries with their SQL counterparts."""
