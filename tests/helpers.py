"""Helpers of the tests: the small tables, sorted rows, and the same from SQL."""

SMALL = "/root/testdata/sf0.001"


def rows(df):
    """Sorted rows with columns by name."""
    return sorted((tuple(str(v) for _, v in sorted(r.asDict(recursive=True).items())) for r in df.collect()))


def oracle(sql, sf_dir=SMALL):
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = c.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(str(r[k]) for k in order) for r in found.fetchall())
