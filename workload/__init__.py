"""Hospital feeds derived from the supplied tables, and the queries that run on them."""
