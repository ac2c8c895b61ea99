"""Customer intelligence on Spark: cleaning, features, scores, alerts and monitoring."""
