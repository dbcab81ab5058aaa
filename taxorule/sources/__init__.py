"""Sources and sinks: match documents, snapshot store, test-table binding."""
