"""Entity-by-month snapshot features, labels, models and drift on Spark DataFrames."""
