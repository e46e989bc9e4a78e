"""The operators bound to the driver's tables, with a SQL twin for each query."""
