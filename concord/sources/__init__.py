"""Sources and sinks: catalogue scans, readers and writers."""
