"""functions of the posting engine."""
