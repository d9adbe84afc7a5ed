"""DataFrame-to-DataFrame building blocks: cleaning, quality and join summaries."""
