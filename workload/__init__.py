"""The engine applied to the driver's tables: inputs, queries, and their SQL."""
