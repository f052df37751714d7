"""DataFrame-to-DataFrame steps; no temporary views, no actions."""
