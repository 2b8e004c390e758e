"""solidspark: solid-model and mesh data as Spark DataFrames."""
