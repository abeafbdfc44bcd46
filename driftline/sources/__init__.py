"""Schemas, readers, payload flattening and sinks."""
