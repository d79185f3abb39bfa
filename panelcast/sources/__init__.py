"""Scans, bindings of the driver tables to panel concepts, and sinks."""
