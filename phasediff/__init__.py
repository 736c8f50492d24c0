"""phasediff: compare two or more phases of a public budget with Spark DataFrames."""
