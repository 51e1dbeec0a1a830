"""Inputs and outputs: CSV ingestion, the driver-table binding, JSON export."""
