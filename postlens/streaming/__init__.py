"""streaming of the posting engine."""
