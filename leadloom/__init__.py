"""leadloom: lead enrichment and entity resolution as Spark DataFrame jobs."""
