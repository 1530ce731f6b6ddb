"""Assembled plans: gold build, layer checks, reports, layered run."""
