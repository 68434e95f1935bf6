"""Type normalisation of the oracle SQL (mirrors ``normalize.py``): integral
columns to BIGINT, fractional to DOUBLE rounded to 6 digits, timestamps to
text. Column types per query are recorded in ``oracle_types.json`` by
``tools/gen_oracle_types.py`` (DuckDB ``DESCRIBE`` of each query)."""

from __future__ import annotations

import json
import os

_PATH = os.path.join(os.path.dirname(__file__), "oracle_types.json")
_INT = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT",
        "UINTEGER", "UBIGINT")
_FRAC = ("FLOAT", "DOUBLE", "DECIMAL", "REAL")


def _types() -> dict:
    if os.path.exists(_PATH):
        with open(_PATH) as f:
            return json.load(f)
    return {}


def wrap_sql(name: str, sql: str) -> str:
    types = _types().get(name)
    if not types:
        return sql
    repl = []
    for col, t in types:
        q = '"' + col.replace('"', '""') + '"'
        if t.startswith(_INT):
            repl.append(f"CAST({q} AS BIGINT) AS {q}")
        elif t.startswith("DECIMAL"):
            repl.append(f"CAST(round({q}, 6) AS DOUBLE) AS {q}")
        elif t.startswith(_FRAC):
            repl.append(f"round(CAST({q} AS DOUBLE), 6) AS {q}")
        elif t.startswith("TIMESTAMP") or t == "DATE":
            repl.append(f"strftime({q}, '%Y-%m-%d %H:%M:%S') AS {q}")
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS q"
