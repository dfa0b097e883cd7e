"""nearfold: catalogue cleaning, merging and exact content similarity on Spark DataFrames."""
