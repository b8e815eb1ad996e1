"""Customer-feed quality, load and analytics on Spark."""
