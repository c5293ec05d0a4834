"""Disease-surveillance analytics on Spark: landing, cleaning, star schema, reports."""
