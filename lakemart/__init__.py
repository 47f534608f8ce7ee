"""Lake ingestion, analytical marts, business questions and chart preparation on Spark."""
