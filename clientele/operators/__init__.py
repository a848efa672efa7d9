"""The analytics themselves: each function takes and returns DataFrames."""
