"""Batch jobs put together from the sources, operators and sinks."""
