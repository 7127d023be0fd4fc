"""Whole loads composed of sources, operators and sinks."""
