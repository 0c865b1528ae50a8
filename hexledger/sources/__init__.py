"""Readers, writers, catalog steps and JDBC."""
