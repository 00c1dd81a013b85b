"""Readers and writers: driver tables, adapter views, CSV, JSON requests."""
