"""Readers, record mappers and sinks."""
