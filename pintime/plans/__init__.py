"""Composed jobs: feature builds, retrieval, materialization, model, drift."""
