"""Named queries, reports, exports and the ingest job."""
