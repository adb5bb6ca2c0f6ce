"""Plans of the venue-schedule engine."""
