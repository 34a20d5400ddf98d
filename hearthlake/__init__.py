"""Smart-home telemetry analytics on Spark: bronze files to silver readings, a gold star schema, BI measures and ML."""
