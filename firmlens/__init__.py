"""Company analytics on Spark: plain DataFrame functions and pyspark.ml stages."""
