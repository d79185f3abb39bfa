"""Static shares as of any month: equal to those of one cut-off, and blind to later months."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators import static as S


def made(spark, late=10.0):
    """60 months; entity n sells in the last year only, entity m in two states' names is one entity."""
    months = [dt.date(2015 + k // 12, k % 12 + 1, 1) for k in range(60)]
    rows = [("F", e, st, m, float(q)) for e, st in (("a", "X"), ("b", "X"), ("n", "Y")) for k, m in enumerate(months)
            for q in [{"a": k % 7, "b": 0.0 if k < 40 else 3.0, "n": late if k >= 48 else 0.0}[e]]]
    rows += [("O", "a", "X", m, 0.0) for m in months]
    return spark.createDataFrame(rows, "Family string, FIPS string, State string, date date, Sales_QTY double"), months


def test_equals_one_cut_off_at_a_time(spark):
    panel, months = made(spark)
    every = S.shares_by_month(panel)
    assert every.count() == panel.count()
    for cut in (months[0], months[35], months[36], months[37], months[47], months[59]):
        want = S.static_shares(panel, cut)
        got = every.filter(F.col("as_of") == F.lit(cut)).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), cut


def test_no_month_knows_a_later_one(spark):
    (panel, months), (other, _) = made(spark), made(spark, late=5000.0)
    before = F.col("as_of") <= F.lit(months[47])
    keys = ["Family", "FIPS", "as_of"]
    a, b = (sorted(map(str, S.shares_by_month(p).filter(before).orderBy(*keys).collect())) for p in (panel, other))
    assert a == b
    new = S.shares_by_month(panel).filter("FIPS = 'n'").orderBy("as_of").collect()
    assert [r.county_alltime_share for r in new[:48]] == [0.0] * 48 and new[48].county_alltime_share > 0
    assert [r.county_is_sparse for r in new[48:54]] == [1, 1, 1, 1, 1, 0]


def test_absent_entities_have_no_share(spark):
    panel, months = made(spark)
    rows = panel.filter(F.col("date") == F.lit(months[3])).withColumn("as_of", F.add_months("date", -12))
    got = S.with_shares(rows, S.shares_by_month(panel), ["Family", "FIPS", "State", "as_of"]).collect()
    assert len(got) == 4 and all(r.county_alltime_share == 0 and r.county_is_sparse == 1 for r in got)
