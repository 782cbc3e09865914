"""Registered queries over the driver's tables, each with the SQL it must agree with."""

from maskwright.catalog import evaluating, feeding, files, profiling, publishing, running, scoring, tensors

MODULES = (evaluating, feeding, tensors, profiling, scoring, files, publishing, running)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
