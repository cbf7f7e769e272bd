"""Running the stateless extraction and cleaning on streaming DataFrames."""
