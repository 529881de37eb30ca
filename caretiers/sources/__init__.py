"""Reading bundles and Parquet, and the tables of the three layers."""
