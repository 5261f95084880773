"""Composite pipelines built from the operators: generate, merge, views, evaluate."""
