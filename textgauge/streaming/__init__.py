"""Row operators on streams."""
