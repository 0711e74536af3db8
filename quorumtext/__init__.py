"""Page-text consensus analytics on Spark."""
