"""Sources of the venue-schedule engine."""
