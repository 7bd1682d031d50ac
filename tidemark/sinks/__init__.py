"""Writers of topics, dimension tables and summaries."""
