"""corpusflow: crawl-corpus analytics as Spark DataFrame and streaming jobs."""
