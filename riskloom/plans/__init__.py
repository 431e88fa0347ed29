"""Multi-step jobs, sinks, the query registry and the SQL oracle texts."""
