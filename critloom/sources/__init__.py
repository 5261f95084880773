"""Sources and sinks: input tables, job outputs, versioned publication, metric tables."""
