"""Bronze inputs: declared schemas, the driver-table mapping, CSV ingest and catalog helpers."""
