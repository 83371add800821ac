"""rollcall: workforce-activity ETL and reporting as Spark DataFrame jobs."""
