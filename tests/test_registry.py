import __spark_entry__ as E
from tests.conftest import SF


def test_registry_shape():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["qid", "vec_id", "score", "rank"]


def test_every_query_equals_its_oracle_on_smoke_data(spark):
    import duckdb

    from tools.check_oracle import TABLES, rows_of
    from vexa.plans import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, wrong = E.queries(), []
    for name in QUERIES:
        df = qs[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
        if name not in ORACLES:
            if not rows:
                wrong.append(name)
            continue
        res = con.execute(ORACLES[name])
        cols = [d[0] for d in res.description]
        if sorted(cols) != sorted(df.columns) or rows_of(df.columns, rows) != rows_of(cols, res.fetchall()):
            wrong.append(name)
    assert not wrong
