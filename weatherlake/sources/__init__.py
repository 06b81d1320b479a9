"""Sources and sinks: METAR CSV ingest, stored layouts, scans, station files."""
