"""Structured Streaming jobs: windowed daily KPIs and per-batch quality checks."""
