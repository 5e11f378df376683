"""Customer value analytics on Spark: from transaction lines to named segments."""
