"""tradelake: market-trade analytics written as Spark jobs."""
