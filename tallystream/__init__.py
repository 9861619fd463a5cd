"""Statement change data on Spark: extract, clean, capture, publish, apply."""
