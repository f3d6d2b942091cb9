"""A bounded number of households in a task."""

from meterspan import fixed
from meterspan.operators import whatif


def test_households_are_dealt_out_before_the_recommendations(spark, monkeypatch):
    monkeypatch.setattr(whatif, "HOUSEHOLDS_IN_TASK", 3)
    ids = [*range(10), 3, None, None]
    homes = spark.createDataFrame([(i, 5.0) for i in ids], "household_id long, tariff double").coalesce(1)
    priced = whatif.price_recommendations(homes)
    assert priced.rdd.getNumPartitions() == 5
    got = whatif.category_counts(priced).collect()
    want = {}
    for i in ids:
        for rec in fixed.RECOMMENDATIONS:
            for name in ("All", rec[1]):
                want[i, name] = want.get((i, name), 0) + 1
    assert {(r.household_id, r.category): r["count"] for r in got} == want and len(got) == len(want)
