"""operators of the posting engine."""
