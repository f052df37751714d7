"""Readers: table formats, JDBC, event topic, CSV."""
