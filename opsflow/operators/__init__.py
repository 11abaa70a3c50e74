"""DataFrame -> DataFrame operators, grouped by job family."""
