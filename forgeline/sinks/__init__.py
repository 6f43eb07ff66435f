"""Writers: Parquet tables, versioned publishing, snapshots, archive, JDBC."""
