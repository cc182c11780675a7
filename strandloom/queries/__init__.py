"""Registered reference-parity queries."""

from strandloom.queries import annotation, events, formats, graphs, intervals, joins, models, reports, sequences, splice, streams  # noqa: F401
from strandloom.queries.registry import ORACLES, QUERIES  # noqa: F401
