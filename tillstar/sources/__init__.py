"""Reading, staging, storing and profiling tables."""
