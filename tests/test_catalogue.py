import duckdb
import pytest

from helixframe.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations"]


def rows(frame):
    cell = lambda x: None if x is None or x != x else round(float(x), 6) if isinstance(x, (int, float)) or getattr(getattr(x, "dtype", None), "kind", "") in "iuf" and getattr(x, "dtype", None) is not None else str(x)
    return sorted((tuple(cell(x) for x in r) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(db.sql(catalogue.SQL[name]).df())
