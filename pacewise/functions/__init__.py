"""Column expressions: normalisation, measures, display texts, GeoJSON features."""
