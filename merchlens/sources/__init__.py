"""Readers, model-table bindings, lookups and sinks."""
