"""Screening operators as DataFrame and column expressions."""
