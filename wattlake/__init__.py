"""wattlake: medallion analytics for plant and generation data, as plain Spark jobs."""
