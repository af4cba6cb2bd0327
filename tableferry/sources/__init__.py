"""Sources: parquet and JDBC scans, the column catalog, paged scans."""
