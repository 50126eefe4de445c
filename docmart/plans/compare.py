"""Local twin of the driver's correctness gate: run a registered query and its
oracle SQL in DuckDB on the same parquet files, compare row count, column
names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math


def _norm(v):
    if v is None:
        return "∅"
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "∅"
    except Exception:
        pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return str(v)


def frame_digest(pdf) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("\x1f".join(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))
    return len(rows), cols, hashlib.sha256("\x1e".join(rows).encode()).hexdigest()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def duck_relation(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con, con.sql(sql)


def duck_frame(sql: str, sf_dir: str):
    con, rel = duck_relation(sql, sf_dir)
    return rel.df()


def compare(spark, name: str, sf_dir: str) -> dict:
    from . import ORACLE_SQL, QUERIES
    sq = QUERIES[name](spark, sf_dir)
    stypes = {c: SPARK_TO_DUCK.get(t, t) for c, t in sq.dtypes}
    sdf = sq.toPandas()
    out = {"query": name, "spark_rows": len(sdf)}
    if name not in ORACLE_SQL:
        out["oracle"] = None
        return out
    con, rel = duck_relation(ORACLE_SQL[name], sf_dir)
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    odf = rel.df()
    s, o = frame_digest(sdf), frame_digest(odf)
    out.update(oracle_rows=len(odf), cols_match=s[1] == o[1], types_match=stypes == otypes, hash_match=s == o)
    if stypes != otypes:
        out["type_diff"] = {c: (stypes.get(c), otypes.get(c)) for c in set(stypes) | set(otypes)
                            if stypes.get(c) != otypes.get(c)}
    if s[1] != o[1]:
        out["spark_cols"], out["oracle_cols"] = s[1], o[1]
    return out
