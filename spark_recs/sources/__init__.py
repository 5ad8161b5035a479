"""Sources and sinks: explicit schemas, checked Parquet reads, writers,
the test-data fixture mapping and the model store."""
