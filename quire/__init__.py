"""quire: a PySpark engine that turns page-and-block JSON of document parsers into retrieval chunks."""
