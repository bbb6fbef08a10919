"""User-level jobs composed from sources, operators and sinks."""
