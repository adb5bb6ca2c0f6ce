"""Functions of the venue-schedule engine."""
