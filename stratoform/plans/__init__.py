"""Silver, gold, quality, analytical and summary plans."""
