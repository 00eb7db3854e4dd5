"""Readers for landed responses, per-source mappers and sinks."""
