"""The weekly jobs, put together from the operators and writes."""
