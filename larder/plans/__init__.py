"""Whole pipelines composed of sources, operators and sinks."""
