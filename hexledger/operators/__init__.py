"""Relational, profiling, spatial, feature and model operators, each DataFrame to DataFrame."""
