"""ordermart - a Spark-native commerce order mart.

Layers: source files -> raw (text + lineage) -> staging (typed, cleaned)
-> analytics (dimensions, facts) -> reporting views -> checks -> JSON export.
"""

__version__ = "0.1.0"
