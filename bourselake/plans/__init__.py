"""Jobs that decide what to load next."""
