"""Sources and sinks of bundles."""
