"""tideline: daily audience scoring and monthly retraining as Spark DataFrame jobs."""
