"""Streaming of the venue-schedule engine."""
