"""Sources and sinks: landing readers, the test fixture, layer tables."""
