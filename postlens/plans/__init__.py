"""plans of the posting engine."""
