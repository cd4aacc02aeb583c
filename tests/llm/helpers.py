import duckdb


def tables(con, sf_dir, *names):
    for n in names:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{n}.parquet'")


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)


def sql_rows(sql, sf_dir, *names):
    con = duckdb.connect()
    tables(con, sf_dir, *names)
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    return cols, sorted((tuple(r) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()), key=repr)


def same(df, sql, sf_dir, *names):
    cols, want = sql_rows(sql, sf_dir, *names)
    assert sorted(df.columns) == cols
    assert rows_of(df) == want
    return want
