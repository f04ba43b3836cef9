"""Part of tracewright."""
