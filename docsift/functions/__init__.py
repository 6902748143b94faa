"""Column-level helpers: text analysis, score modifiers, dates, packing, vectors, scripts."""
