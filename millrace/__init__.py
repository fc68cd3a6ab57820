"""PySpark pipeline operators: app traffic, regional orders, staging loads, fraud models."""
