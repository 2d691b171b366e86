"""helixframe: genomic interval, sequence and variant operators on Spark DataFrames."""
