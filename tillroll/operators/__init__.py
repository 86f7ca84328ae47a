"""Table builders. Every function maps DataFrames to a DataFrame and uses only built-in
Spark operators; none collects data to the driver."""
