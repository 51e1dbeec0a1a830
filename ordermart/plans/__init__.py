"""Composition: the lazy layer graph, the registered queries, the pipeline."""
