"""Run registered queries against their SQL in DuckDB on the same Parquet files."""
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def table_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(body, key=repr)


def difference(spark_df, sf_dir, sql):
    """None when equal, else a short text."""
    got_names, got = table_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want_names, want = table_rows(*oracle_rows(sf_dir, sql))
    if got_names != want_names:
        return f"columns {set(got_names) ^ set(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return "; ".join(f"{n}: {a!r} != {b!r}" for n, a, b in zip(got_names, g, w) if a != b)[:600]
    kinds = {n: (type(a), type(b)) for g, w in zip(got[:200], want[:200])
             for n, a, b in zip(got_names, g, w) if type(a) is not type(b)}
    return f"types {kinds}" if kinds else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from portfolio_ops import build_session
    sf = sys.argv[1]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                    "spark.ui.enabled": "false",
                                                    "spark.driver.memory": "12g",
                                                    "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                result = difference(df, sf, oracles[name]) or "equal"
            else:
                result = f"rows only: {df.count()}"
        except Exception as error:  # report and go on to the next query
            result = f"ERROR {str(error)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {result}", flush=True)
