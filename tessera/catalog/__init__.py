"""Queries that apply the operators to the given tables, each with the SQL that gives the same rows."""

from . import audit, claims, contracts, documents, evidence, extraction, naming, planning, program, programs, reading, rulebook, state, stored, tables, web, windows  # noqa: F401
