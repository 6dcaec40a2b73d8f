"""Compare registered queries with their SQL, value by value."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    plain = [tuple(_plain(r[i]) for i in places) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
    "int": "INTEGER",
}


def compare(df, con, sql):
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {
        n: (t, kinds[n]) for n, t in df.dtypes if _KINDS.get(t, t) != kinds[n] and kinds[n] != "STRING"
    }
    expected = _rows(names, cursor.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"got {a}\nexpected {b}"
    if wrong:
        return f"types {wrong}"
    return None


def main(sf_dir, only):
    from __spark_entry__ import oracle_sql, queries
    from bench import session

    spark, con, sql, failed = session(**{"spark.ui.showConsoleProgress": "false"}), connect(sf_dir), oracle_sql(), []
    for name, fn in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            difference = compare(fn(spark, sf_dir), con, sql[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        rows = con.execute(f"SELECT count(*) FROM ({sql[name]})").fetchall()[0][0] if not difference else ""
        print(f"{name}: {'ok' if difference is None else difference} {rows} {time.time() - start:.1f}s", flush=True)
        if difference:
            failed.append(name)
    print("missing oracles:", sorted(set(queries()) - set(sql)), "unused:", sorted(set(sql) - set(queries())))
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
