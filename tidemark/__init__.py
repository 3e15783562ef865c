"""tidemark: daily panels, forecasts and their honest measurement on Spark DataFrames."""
