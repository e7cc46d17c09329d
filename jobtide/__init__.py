"""Job-posting analytics on Spark: DataFrame in, DataFrame out."""
