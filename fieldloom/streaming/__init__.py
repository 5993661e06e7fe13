"""Item batches that arrive over time."""
