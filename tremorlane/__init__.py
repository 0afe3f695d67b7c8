"""Seismic event analytics on Spark: ingest, label, cluster, summarise."""
