"""Plans: the layer set, the report queries and the layered writes."""
