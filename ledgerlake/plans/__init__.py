"""One function per published table; inputs are DataFrames, the result is a DataFrame."""
