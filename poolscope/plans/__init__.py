"""Complete runs, and the registered queries with their reference SQL."""
