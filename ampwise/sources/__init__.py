"""Inputs: raw day-file text scans and typed projection (``raw``), record
layouts and header configs (``schemas``), and the telemetry stand-in built
from the provided tables (``fixture``)."""
