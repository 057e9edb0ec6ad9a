"""Statistical microdata synthesis, repair and audit on Spark DataFrames."""
