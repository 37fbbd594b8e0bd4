"""Run queries next to their SQL and compare rows. Usage: oracle_check.py FOLDER [name ...]"""

import math
import pathlib
import sys
import time
import traceback

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


def compare(spark, con, name, function, sql, folder):
    """None when equal, else what differs."""
    df = function(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got:
        return "no rows on either side"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ in {sorted(columns)}, e.g. {bad[0][0]} != {bad[0][1]}"
    kinds = [(c, type(g).__name__, type(w).__name__) for row in zip(got, want) for c, g, w in zip(sorted(columns), *row) if type(g) is not type(w)]
    return f"types {kinds[0]}" if kinds else None


def main(folder, names):
    from lodgewise.session import build_session
    import __spark_entry__ as entry

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    oracles, failed = entry.oracle_sql(), []
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, function, oracles[name], folder) if name in oracles else f"no SQL, {function(spark, folder).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        if problem and not problem.startswith("no SQL"):
            failed.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'equal'}"[:900], flush=True)
    print("FAILED:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
