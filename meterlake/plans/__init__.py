"""Whole jobs: zones end to end, serving tables and questions, reports."""
