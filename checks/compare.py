"""Run the registered queries against the comparison engine on one scale.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def difference(query, sql, spark, con, sf_dir):
    """None when both sides agree, else a short description."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:2]
        only_theirs = [r for r in theirs if r not in set(ours)][:2]
        return f"rows {len(ours)} / {len(theirs)}; only ours {only_ours}; only theirs {only_theirs}"
    return None


def session(cores="8"):
    from pyspark.sql import SparkSession

    return (SparkSession.builder.master(f"local[{cores}]").appName("compare")
            .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
            .config("spark.ui.showConsoleProgress", "false").getOrCreate())


def main():
    from checks import ORACLES, QUERIES

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, run in QUERIES.items():
        if chosen and not any(c in name for c in chosen):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(run, ORACLES[name], spark, con, sf_dir)
            else:
                problem, n = None, run(spark, sf_dir).count()
                name = f"{name} (no SQL, {n} rows)"
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {(problem or '')[:900]}", flush=True)
    print(f"{failed} failed of {len(QUERIES)}")


if __name__ == "__main__":
    main()
