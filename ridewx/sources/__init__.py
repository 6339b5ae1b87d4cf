"""Readers (tables, fixtures, landed responses, the events stand-in) and sinks."""
