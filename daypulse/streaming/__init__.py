"""Structured Streaming jobs: first-launch dedup, sinks, hourly rollups."""
