"""Independent SQL restatements of every registered query."""
