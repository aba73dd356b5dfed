"""Sources and sinks: edge-list / assignment CSV files and graphs derived from tables."""
