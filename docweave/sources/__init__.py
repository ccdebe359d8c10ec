"""Sources and sinks: documents, JSON lines, settings, output tables."""
