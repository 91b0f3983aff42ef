"""Ad, trip, passenger and staff analytics on Spark DataFrames, Spark SQL and spark.ml."""
