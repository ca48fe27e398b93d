"""Stock-market analytics on Spark: price bars, financial statements, news backlog, chart figures."""
