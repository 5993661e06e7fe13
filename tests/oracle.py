"""Compare a query with its oracle, independent of row and column order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from fieldloom.sources.tables import TABLES


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    return v


def sort_key(row):
    return tuple((x is not None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in row)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences, empty when both sides agree."""
    got_cols = sorted(df.columns)
    got = [tuple(canon(r[c]) for c in got_cols) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_cols = sorted(names)
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    pos = [names.index(c) for c in want_cols]
    want = [tuple(canon(row[i]) for i in pos) for row in rel.fetchall()]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    types = []
    for i, c in enumerate(want_cols):
        a = {type(r[i]).__name__ for r in got if r[i] is not None}
        b = {type(r[i]).__name__ for r in want if r[i] is not None}
        if a and b and a != b:
            types.append(f"{c}: {a} != {b}")
    out += types
    if not types:
        g, w = sorted(got, key=sort_key), sorted(want, key=sort_key)
        bad = [(x, y) for x, y in zip(g, w) if x != y]
        if bad:
            only_g = [x for x in set(map(str, g)) - set(map(str, w))][:2]
            only_w = [x for x in set(map(str, w)) - set(map(str, g))][:2]
            out.append(f"{len(bad)} rows differ; cols={want_cols}; spark only={only_g}; oracle only={only_w}")
    return out
