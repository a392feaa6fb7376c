"""Readers: raw feed files, segment files, dimensions, GeoJSON documents."""
