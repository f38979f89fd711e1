"""Plans: the offer job (bronze -> silver -> gold) and the query catalogue."""
