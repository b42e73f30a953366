"""Batch jobs: raw -> bronze -> silver -> gold -> BI."""
