"""Jobs: operators put together."""
