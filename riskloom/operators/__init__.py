"""DataFrame → DataFrame operators, grouped by the job family they serve."""
