"""Run catalogue queries next to their SQL oracles and compare every value."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("lineitem", "events", "documents", "pages", "benchmark", "labels", "embeddings")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normalised(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, one spelling of missing values."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].isna().any():  # pandas turns integers with gaps into floats, or not
            df[c] = df[c].convert_dtypes()
    text = df.astype(object).where(df.notna(), None)
    order = text.map(repr).agg("|".join, axis=1).sort_values(kind="stable").index if len(df) else []
    return text.loc[order].reset_index(drop=True)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} against {len(sql_df)}"
    for c in spark_df.columns:
        kinds = spark_df[c].dtype.kind, sql_df[c].dtype.kind
        gaps = spark_df[c].isna().any() or sql_df[c].isna().any()
        if kinds[0] != kinds[1] and not {"O"} & set(kinds) and not gaps:
            return f"type of {c}: {spark_df[c].dtype} against {sql_df[c].dtype}"
    a, b = normalised(spark_df), normalised(sql_df)
    unequal = (a.map(repr) != b.map(repr)).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows, first:\n{a[unequal].head(3)}\n{b[unequal].head(3)}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from kerbside.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare", cores=8), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    sql = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - began
            found = difference(got, con.sql(sql[name]).df()) if name in sql else "no oracle"
        except Exception as error:  # report and go on
            took, found, got = time.time() - began, f"{type(error).__name__}: {error}"[:1500], []
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name:34s} {len(got):7d} {took:6.2f}s", flush=True)
        if found:
            print("   ", found, flush=True)
    print("bad:", bad, "without query:", sorted(set(sql) - set(contract.queries())))
