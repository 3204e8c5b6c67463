"""Importing this module registers every query."""

from tapeline.plans import audits, breakdowns, curation, documents, files, logs, meshes, runs, sheets  # noqa: F401
from tapeline.plans.registry import OPERATORS, ORACLE, QUERIES  # noqa: F401
