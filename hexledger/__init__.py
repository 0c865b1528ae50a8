"""Geo-transaction analytics as plain DataFrame functions on Spark SQL and Spark ML."""
