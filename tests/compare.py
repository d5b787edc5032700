"""Run a registered query and its SQL side by side and compare columns, types and values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    return value


def _rows(arrow) -> list[tuple]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(c).to_pylist() for c in names]
    rows = [tuple(_cell(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _types(arrow) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in arrow.schema}


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Human-readable differences; an empty list means equal."""
    ours = query(spark, sf_dir).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    out = []
    if _types(ours) != _types(theirs):
        a, b = _types(ours), _types(theirs)
        out.append("schema: " + str({c: (a.get(c), b.get(c)) for c in sorted({*a, *b}) if a.get(c) != b.get(c)}))
    if ours.num_rows != theirs.num_rows:
        out.append(f"rows: {ours.num_rows} vs {theirs.num_rows}")
    if not out or set(_types(ours)) == set(_types(theirs)):
        left, right = _rows(ours), _rows(theirs)
        wrong = [(x, y) for x, y in zip(left, right) if x != y]
        if wrong:
            names = sorted(ours.column_names)
            x, y = wrong[0]
            out.append(f"values: {len(wrong)} rows, e.g. "
                       + str({c: (p, q) for c, p, q in zip(names, x, y) if p != q})[:400])
    return out
