"""Registered queries and pipelines."""
