"""Training-data operators: packing, search, joins, language ID, dedup, counts, mixing, chat, secrets, media."""
