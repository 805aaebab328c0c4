"""Align oracle result types with the Spark outputs: DECIMAL -> DOUBLE, HUGEINT -> BIGINT.

Spark outputs money as DOUBLE (``plans.registry.to_double``) while DuckDB keeps DECIMAL for sums.
The result columns of each oracle query are found with DuckDB's DESCRIBE (binding only, nothing is
executed) over the smallest test tables, and DECIMAL ones are cast in an outer SELECT.
"""

from __future__ import annotations

import os

VIEW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES_DIR = "/root/testdata/sf0.001"


def _connection():
    import duckdb

    con = duckdb.connect()
    for t in VIEW_TABLES:
        path = os.path.join(TYPES_DIR, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _spark_like(duck_type: str) -> str | None:
    """Target type for a DuckDB result type that Spark represents differently (None = keep)."""
    if duck_type.startswith("DECIMAL"):
        return "DOUBLE"
    if duck_type == "HUGEINT":
        return "BIGINT"
    return None


def cast_decimals(queries: dict[str, str]) -> dict[str, str]:
    try:
        con = _connection()
    except Exception:  # noqa: BLE001 - no DuckDB: leave the SQL as written
        return dict(queries)
    out = {}
    for name, sql in queries.items():
        try:
            cols = con.execute(f"DESCRIBE {sql}").fetchall()
        except Exception:  # noqa: BLE001
            out[name] = sql
            continue
        target = {c[0]: _spark_like(str(c[1]).upper()) for c in cols}
        if not any(target.values()):
            out[name] = sql
            continue
        exprs = [f'CAST("{c[0]}" AS {target[c[0]]}) AS "{c[0]}"' if target[c[0]] else f'"{c[0]}"' for c in cols]
        out[name] = f"SELECT {', '.join(exprs)} FROM (\n{sql}\n) AS oracle_result"
    con.close()
    return out
