"""Assemble each query with exactly the relations it needs as CTEs."""

from __future__ import annotations

import re

from .checks import CHECK_QUERIES
from .feeds import FEEDS
from .models import MODELS
from .operators import OPERATORS

RELATIONS = {**FEEDS, **MODELS}
HELPERS = {"stints", "dated_stints", "live_rows", "walked", "covered", "gone_round", "strayed"}
WORD = re.compile(r"[a-z_]+[a-z0-9_]*")


def needed(sql: str, seen: dict[str, None]) -> None:
    for name in dict.fromkeys(WORD.findall(sql)):
        if name in RELATIONS and name not in seen:
            body = RELATIONS[name]
            seen[name] = None
            needed(body, seen)


def with_relations(sql: str, own: str = "") -> str:
    wanted: dict[str, None] = {}
    needed(sql, wanted)
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in RELATIONS.items() if name in wanted)
    return f"WITH RECURSIVE {ctes}\n{sql.strip()}" if ctes else sql.strip()


def oracle_queries() -> dict[str, str]:
    models = [name for name in MODELS if name not in HELPERS]
    out = {name: with_relations(f"SELECT * FROM {name}") for name in models}
    for name, sql in {**OPERATORS, **CHECK_QUERIES}.items():
        out[name] = with_relations(f"SELECT * FROM ({sql.strip()})")
    return out
