"""Schemas, readers, sinks and catalog checks."""
