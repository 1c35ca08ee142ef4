"""Evidence linkage between two catalogues, on Spark DataFrames."""
