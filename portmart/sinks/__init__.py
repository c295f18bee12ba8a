"""Writers: Parquet (plain and partitioned), CSV, staging, partition refresh."""
