"""Change feeds derived from the given order tables, and the queries run on them."""
