"""Recruitment-event metrics as Spark jobs: ingest, clean, aggregate, enrich, load, report."""
