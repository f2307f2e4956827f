"""Sources and sinks: CSV scans and the path-addressed layer store."""
