"""Sources and sinks: CSV by position / name, zipped CSV, JSON envelopes, versioned Parquet tables."""
