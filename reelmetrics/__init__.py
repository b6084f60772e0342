"""Video-platform analytics expressed as Spark DataFrame jobs."""
