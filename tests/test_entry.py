import __spark_entry__ as E
from support import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["movie1", "movie2", "corr"] and df.count() > 0


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_text_queries_small(spark):
    q = E.queries()
    w = q["word_count_total"](spark, SF_SMALL).first()
    assert w.words > w.lines > 0
    assert q["column_correction"](spark, SF_SMALL).count() > 0
