"""Structured Streaming jobs: trip sessions with watermarks (``trips_stream``)."""
