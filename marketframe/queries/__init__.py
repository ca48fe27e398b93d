"""Registered queries over the driver's tables, each with the SQL that states its expected result."""

from marketframe.queries import charts, news, prices, statements

MODULES = (prices, statements, charts, news)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
# queries whose result has an order that is part of it
ORDERED = ("bars_sorted", "statement_ranking")

ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
