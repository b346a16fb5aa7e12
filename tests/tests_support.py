import duckdb

from check import TABLES, canonical

SF = "/root/testdata/sf0.001"


def same_result(spark, name, run, sql):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = run(spark, SF)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, found.fetchall())
