"""Feature vectors, models, tuning and scoring with spark.ml."""
