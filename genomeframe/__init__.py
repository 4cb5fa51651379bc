"""genomeframe: interval algebra, sequencing formats and data preparation on Spark DataFrames."""
