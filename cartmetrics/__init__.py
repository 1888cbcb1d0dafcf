"""Commercial KPI engine: standardize, check, aggregate, join and score sales data on Spark."""

__version__ = "0.1.0"
