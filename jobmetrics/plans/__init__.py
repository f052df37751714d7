"""Whole jobs: build and load the fact, the registered queries and their SQL twins."""
