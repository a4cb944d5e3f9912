"""Scans and sinks: declared schemas, CSV / Parquet readers and writers, and
the adapter that derives basket tables from the driver's test tables."""
