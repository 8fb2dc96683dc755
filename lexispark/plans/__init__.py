"""Workflows: cross-validation, search, reports and prediction files."""
