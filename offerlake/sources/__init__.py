"""Sources and sinks: raw JSON feeds, immutable bronze landing, table writers."""
