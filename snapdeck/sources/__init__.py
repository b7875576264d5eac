"""Schemas, JSON feed ingest, the raw lake and driver-table fixtures."""
