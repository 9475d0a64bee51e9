"""Staging, mart, report, analytics and data-quality operators."""
