"""As-of join against brute force."""

import random

import pytest

from opslake.operators.asof import as_of
from opslake.plans import retrieval


def plain(asked, rows):
    out = []
    for q, key, at in asked:
        best = [r for r in rows if at is not None and r[1] is not None and r[0] == key and r[1] <= at]
        best = max(best, key=lambda r: (r[1], r[2] is not None, r[2] or "", -r[3]), default=None)
        out.append((q, key, at, *(best[1:] if best else (None, None, None))))
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_brute_force_with_a_hot_key(spark, rows, how):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    held = [(key(), rng.choice([None, *range(30)]), rng.choice(["v1", "v2", "v10", None]), i) for i in range(250)] + [("late", 99, "v1", 999)]
    asked = [(i, key(), rng.choice([None, *range(-3, 40)])) for i in range(800)] + [(9000, "late", 5), (9001, "unknown", 5), (9002, "hot", 7), (9002, "hot", 7)]
    a = spark.createDataFrame(asked, "q long, k string, t int").repartition(6)
    r = spark.createDataFrame(held, "k string, since int, version string, id long").repartition(3)
    got = as_of(a, r, ["k"], "t", "since", [("version", True), ("id", False)], how)
    assert got.columns == ["q", "k", "t", "since", "version", "id"]
    want = plain(asked, held)
    assert rows(got) == sorted([w for w in want if how == "left" or w[-1] is not None], key=repr)


def test_empty_sides_and_clashes(spark):
    a = spark.createDataFrame([(1, "a", 5)], "q long, k string, t int")
    r = spark.createDataFrame([("a", 3, 7)], "k string, since int, id long")
    assert as_of(a, r.limit(0), ["k"], "t", "since").count() == 0
    assert [tuple(x) for x in as_of(a, r.limit(0), ["k"], "t", "since", how="left").collect()] == [(1, "a", 5, None, None)]
    assert as_of(a.limit(0), r, ["k"], "t", "since", how="left").count() == 0
    for bad in ({"how": "outer"}, {"rows": r.withColumnRenamed("id", "q")}):
        with pytest.raises(ValueError):
            as_of(a, bad.get("rows", r), ["k"], "t", "since", how=bad.get("how", "inner"))


def test_many_dates_agree_with_one(spark, rows):
    docs = spark.createDataFrame([(f"D{i}", f"F{i % 3}", f"v{i % 5}", f"2024-0{i % 6 + 1}-01") for i in range(40)], "document_id string, purpose string, version string, effective_date string")
    for day in ("2024-01-01", "2024-03-15", "2023-01-01"):
        asked = docs.select("purpose").distinct().selectExpr("purpose", f"'{day}' as asked")
        many = retrieval.versions_at(docs, asked, "purpose", "effective_date", "asked").select("document_id", "purpose", "version", "effective_date")
        assert rows(many) == rows(retrieval.version_at(docs, "purpose", "effective_date", day).select("document_id", "purpose", "version", "effective_date"))
