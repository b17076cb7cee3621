"""Sources and sinks: table scans, inputs derived from the test tables, text formats."""
