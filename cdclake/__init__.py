"""Change-data-capture warehouse engine on Spark DataFrames."""
