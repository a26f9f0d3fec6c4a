"""Customer-value analytics on Spark DataFrames: cleaning, star schema, RFM
scoring, segment history, product ranking and the reports built on them."""
