"""Schemas, readers, sinks, staged tables and the adapters of the test tables."""
