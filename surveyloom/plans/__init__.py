"""Plans over DataFrames."""
