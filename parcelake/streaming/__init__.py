"""Structured Streaming jobs: raw ingest and the live shipment table."""
