"""What the driver and the tests need: test inputs shaped like the landing files, and the DuckDB statements to match."""
