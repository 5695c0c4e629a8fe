"""Log analytics and root-cause engine on Spark DataFrames, and operators for training-data pipelines."""
