"""Registered queries of this subpackage."""

from kinelake.llm import decontam, mixing, percentiles, rests, splits, subjects

MODULES = [rests, percentiles, splits, decontam, subjects, mixing]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
