"""Writers: Parquet tables and JDBC tables, both safe to repeat for the same micro-batch."""
