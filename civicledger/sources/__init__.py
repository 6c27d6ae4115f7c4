"""Sources and sinks: landed JSON feeds, the states seed, versioned Parquet tables."""
