"""gleanery: refine crawled pages and API documents into clean, keyed tables on Spark."""
