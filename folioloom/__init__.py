"""Book catalogue analytics and corpus preparation on Spark."""
