"""Event streams: ingestion in micro-batches, counters that survive a repeated batch, windows."""
