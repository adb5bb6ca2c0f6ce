"""Operators of the venue-schedule engine."""
