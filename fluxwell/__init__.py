"""Device telemetry analytics on PySpark: ingest, validation, routing, windows, reports."""
