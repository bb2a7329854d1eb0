"""Results as multisets of rows, for comparing Spark with DuckDB."""


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return round(value, 9)
    if value.__class__.__name__ == "Decimal":
        return round(float(value), 9)
    if hasattr(value, "asDict") or isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def same(spark_df, con, sql):
    columns = sorted(spark_df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in spark_df.collect()), key=repr)
    found = con.sql(sql)
    names = list(found.columns)
    assert sorted(names) == columns
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()), key=repr)
    assert got == want
