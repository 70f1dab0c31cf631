"""Event-log analytics on Spark: landing, star schema, rollups, reports and quality rules."""
