"""Column functions: names, addresses, URLs, markup, provenance."""
