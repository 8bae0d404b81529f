"""Run a registered query and its SQL side by side."""

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype):
    return {"i": "int", "u": "int", "f": "float", "b": "bool"}.get(dtype.kind, "text")


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True) if len(df.columns) else df


def differences(left: pd.DataFrame, right: pd.DataFrame) -> list[str]:
    if sorted(left.columns) != sorted(right.columns):
        return [f"columns {sorted(left.columns)} vs {sorted(right.columns)}"]
    if len(left) != len(right):
        return [f"{len(left)} rows vs {len(right)}"]
    left, right = _sorted(left), _sorted(right)
    out = []
    for c in left.columns:
        if len(left) and _kind(left[c].dtype) != _kind(right[c].dtype):
            out.append(f"{c}: {left[c].dtype} vs {right[c].dtype}")
            continue
        a, b = left[c], right[c]
        bad = ~((a == b) | (a.isna() & b.isna()))
        if bad.any():
            i = bad.idxmax()
            out.append(f"{c}: {int(bad.sum())} values, first {left.loc[i].to_dict()} vs {right.loc[i].to_dict()}")
    return out
