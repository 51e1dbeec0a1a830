"""Transformations of each layer: staging models, marts, reports, checks."""
