"""stratavault: a data-vault analytics library on Spark DataFrames."""
