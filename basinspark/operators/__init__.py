"""DataFrame operators: every function takes and returns DataFrames and takes column names as arguments."""
