"""Readers: dumps, bead/box tables, thermo logs, number matrices, file catalogs."""
