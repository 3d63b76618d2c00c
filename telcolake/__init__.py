"""Customer analytics and churn scoring for subscription businesses, as Spark jobs."""
