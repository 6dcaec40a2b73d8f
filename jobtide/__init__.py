"""Job-posting analytics on Spark: board pages and responses in, one clean posting table out."""
