"""All queries of the catalogue, and the SQL that gives the same rows."""

from __future__ import annotations

from textflow.plans import calls, dialogues, evaluation, groups, texts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (evaluation, groups, texts, dialogues, calls):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
