"""Compare a registered Spark query with its DuckDB oracle.

Row count, column names and an order-insensitive comparison of values (floats
compared to a relative 1e-9). Used by the tests; mirrors the driver's check.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .registry import REGISTRY, oracle_statement, query_fn

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@dataclass
class Outcome:
    key: str
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.rows_spark == self.rows_oracle and self.columns_match and self.values_match


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in RAW_TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        except Exception:  # tables the questions do not read may be absent
            pass
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, float(f"{v:.12g}"))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (3, tuple(_norm(x) for x in v))
    return (4, v) if isinstance(v, (int, bool)) else (5, str(v))


def _rows(records, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in idx) for r in records)


def compare(spark: SparkSession, sf_dir: str, key: str, con=None) -> Outcome:
    con = con or duck(sf_dir)
    sdf = query_fn(key)(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(oracle_statement(key))
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    cols_ok = sorted(s_cols) == sorted(o_cols)
    vals_ok = cols_ok and _rows(s_rows, s_cols) == _rows(o_rows, o_cols)
    detail = ""
    if not cols_ok:
        detail = f"columns spark={s_cols} oracle={o_cols}"
    elif not vals_ok:
        a, b = _rows(s_rows, s_cols), _rows(o_rows, o_cols)
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        detail = f"only spark={diff_a} only oracle={diff_b}"
    return Outcome(key, len(s_rows), len(o_rows), cols_ok, vals_ok, detail)


def compare_all(spark: SparkSession, sf_dir: str, keys=None) -> list[Outcome]:
    con = duck(sf_dir)
    return [compare(spark, sf_dir, k, con) for k in (keys or list(REGISTRY))]
