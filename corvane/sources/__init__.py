"""Sources and sinks of records, truth, id lists and candidate tables."""
