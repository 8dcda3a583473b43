"""Training-data operators: dedup, joins on text, extraction, tokenising, scoring, sharding."""
