"""Training-data operators: dedup, joins, mixing, tokens, scans, language id, quality rules."""
