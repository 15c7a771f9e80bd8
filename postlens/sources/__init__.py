"""sources of the posting engine."""
