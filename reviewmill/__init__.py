"""Review analytics and recommendations expressed as Spark jobs."""
