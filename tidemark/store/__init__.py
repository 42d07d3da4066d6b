"""A feature store on plain Parquet: versioned snapshots with a manifest, governed evolution, a registry."""
