"""Sources and sinks: stage tables, JSON-lines checkpoints, the response store."""
