"""DataFrame -> DataFrame operators with column names as parameters."""
