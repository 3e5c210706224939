"""Sources and sinks: feature store, datasets, topics and the mapping of plain tables to events."""
