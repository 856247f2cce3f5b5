"""Jobs on streams."""
