"""Document-harvest analytics on Spark."""
