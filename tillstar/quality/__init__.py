"""Data-quality rules, their execution, and the reports over the results."""
