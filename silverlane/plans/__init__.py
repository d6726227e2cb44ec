"""Reports and the Gold table: operators put together."""
