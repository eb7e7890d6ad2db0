"""The given tables as the five datasets, the registered queries and their SQL."""
