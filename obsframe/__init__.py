"""Time-stamped observations at places: ingest, latest versions, clusters, summaries, correlations."""
