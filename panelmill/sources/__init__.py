"""Reading and writing: delimited files, parquet, partitioned tables, the test-data adapter."""
