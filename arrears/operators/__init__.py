"""DataFrame operators: watermarks and extracts, change detection and
table maintenance, join helpers."""
