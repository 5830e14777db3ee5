"""Landing-file readers and versioned parquet tables."""
