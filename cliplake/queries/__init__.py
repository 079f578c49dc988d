"""All registered queries and the SQL they are checked against."""

from cliplake.queries import catalogue, documents, media, series, text

MODULES = (catalogue, series, text, documents, media)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
