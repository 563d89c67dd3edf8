"""Readings as a stream: ingest, station join, exposures, history features, scoring."""
