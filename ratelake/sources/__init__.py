"""Sources and sinks: landing files, versioned tables, benchmark stand-ins."""
