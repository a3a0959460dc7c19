"""Sources and sinks: driver-table fixtures, table/CSV readers, the
schema-tolerant batch ingest, writers and report/export sinks."""
