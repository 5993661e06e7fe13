"""Named queries and the written catalog they share."""
