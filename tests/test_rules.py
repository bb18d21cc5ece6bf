"""Unit rules on tiny hand-made frames (FIXTURES.md part C)."""

import datetime as dt

from pyspark.sql import functions as F

from lakeshelf.functions.predicates import decode, flag_text
from lakeshelf.operators import cleaning as cl
from lakeshelf.operators import dims as dm
from lakeshelf.operators import impute as im
from lakeshelf.plans.roles import RENT_PERIODS
from lakeshelf.streaming import alerts as al


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=repr)


def test_mode_tie_smallest_and_null_group_default(spark):
    df = spark.createDataFrame(
        [(1, "g", 2), (2, "g", 2), (3, "g", 3), (4, "g", 3), (5, "g", None),
         (6, "h", None), (7, None, None), (8, None, 4)], "id int, grp string, v int")
    out = im.impute_mode(df, "grp", ["v"], default=1)
    got = dict(out.select("id", "v").collect())
    assert got[5] == 2          # tie 2/3 -> smallest
    assert got[6] == 1          # group with no values -> default
    assert got[7] == 1          # NULL group never matches a lookup
    assert got[8] == 4 and out.count() == 8


def test_overwrite_mode(spark):
    df = spark.createDataFrame([(1, "g", 5), (2, "g", 7), (3, "g", 7), (4, "h", 9)], "id int, grp string, v int")
    got = dict(im.impute_mode(df, "grp", ["v"], overwrite=True).select("id", "v").collect())
    assert got == {1: 7, 2: 7, 3: 7, 4: 9}


def test_exact_median_matches_pandas(spark):
    import pandas as pd
    data = [("a", float(x)) for x in [5, 1, 4, 2]] + [("b", float(x)) for x in [3, 9, 7]] + [("c", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = dict(im.exact_median(df, "g", "v").collect())
    pdf = pd.DataFrame(data, columns=["g", "v"]).dropna()
    assert got == pdf.groupby("g")["v"].median().to_dict()
    low = dict(im.exact_median(df, "g", "v", interpolate=False).collect())
    assert low == {"a": 2.0, "b": 7.0}


def test_decode_and_flags(spark):
    df = spark.createDataFrame([(c,) for c in [0, 1, 2, 3, 9, None]], "c int")
    assert [r[0] for r in df.select(decode("c", RENT_PERIODS)).collect()] == \
        ["Yearly", "Daily", "Monthly", "Yearly", None, None]
    fl = spark.createDataFrame([(c,) for c in [1, 0, 5, None]], "c int")
    assert [r[0] for r in fl.select(flag_text("c")).collect()] == ["Yes", "No", None, None]


def test_try_cast_text(spark):
    df = spark.createDataFrame([("NaN",), ("1.0",), ("7",), ("",)], "t string")
    assert [r[0] for r in cl.typed(df, {"t": "int"}).collect()] == [None, None, 7, None]


def test_upsert_null_key_parity(spark):
    dim = spark.createDataFrame([(1, None, "x")], "id bigint, k string, a string")
    delta = spark.createDataFrame([(None, "x")], "k string, a string")
    assert dm.upsert_dim(dim, delta, ["k"], ["a"]).count() == 2            # re-inserted
    assert dm.upsert_dim(dim, delta, ["k"], ["a"], null_safe=True).count() == 1


def test_surrogate_keys_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = dm.with_surrogate_key(df, ["k"], start=10, partitions=7)
    got = sorted(out.collect(), key=lambda r: r["k"])
    assert [r["id"] for r in got] == list(range(11, 1011))


def test_scd2_cases(spark):
    schema = "id bigint, uid string, name string, is_active int"
    dim = spark.createDataFrame([(1, "A", "a", 1), (2, "B", "b", 1), (3, "D", None, 1)], schema)
    delta = spark.createDataFrame([("A", "a"), ("B", "b2"), ("C", "c"), ("D", "d")], "uid string, name string")
    out = dm.scd2(dim, delta, "uid", ["name"])
    got = rows(out, "uid", "name", "is_active")
    assert set(got) == {("A", "a", 1), ("B", "b", 0), ("B", "b2", 1), ("C", "c", 1), ("D", None, 1)}
    ids = [r[0] for r in out.select("id").collect()]
    assert len(set(ids)) == len(ids)
    ns = rows(dm.scd2(dim, delta, "uid", ["name"], null_safe=True), "uid", "name", "is_active")
    assert ("D", None, 0) in ns and ("D", "d", 1) in ns


def test_date_dim_guard(spark):
    today = dt.date(2024, 5, 10)
    d1 = dm.date_dim(spark, dt.date(2024, 5, 1), today - dt.timedelta(days=1))
    assert dm.extend_date_dim(d1, today).count() == 0
    d2 = dm.date_dim(spark, dt.date(2024, 5, 1), today - dt.timedelta(days=2))
    assert dm.extend_date_dim(d2, today).count() == 2
    empty = spark.createDataFrame([], d1.schema)
    assert dm.extend_date_dim(empty, dt.date(2023, 1, 3)).count() == 3
    r = d1.where(F.col("date") == dt.date(2024, 5, 4)).first()   # a Saturday
    assert (r.date_key, r.day_of_week, r.is_weekend, r.month_name, r.quarter) == (20240504, 7, 1, "May", 2)


def test_classify_order(spark):
    df = spark.createDataFrame(
        [("عاجل سعر", "positive", 0.5), ("كم السعر", "positive", 0.5), ("كم السعر", "negative", 0.5),
         ("أريد شقة", "negative", 0.99), (None, "negative", 0.9), ("hello", None, None)],
        "t string, label string, score double")
    got = [r[0] for r in df.select(al.classify("t", "label", "score")).collect()]
    assert got == ["urgent", "sales_lead", "general", "sales_lead", "complaint", "general"]


def test_dedup_latest_hot_key(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    got = rows(dm.dedup_latest(df, ["k"], ["ts"]))
    assert got == [(0, 4998), (1, 4999), (2, 4997)]


def test_exact_median_hot_value_and_group(spark):
    import pandas as pd
    data = [("a", 5.0)] * 3000 + [("a", 1.0), ("a", 9.0), ("a", 2.0)] + [("b", float(i)) for i in range(10)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    pdf = pd.DataFrame(data, columns=["g", "v"])
    assert dict(im.exact_median(df, "g", "v").collect()) == pdf.groupby("g")["v"].median().to_dict()


def test_lookups_from_added_counts_match_one_count(spark):
    data = [(i % 4 if i % 7 else None, (i * 3) % 5 if i % 6 else None,
             float("nan") if i % 11 == 0 else float(i % 3) / 3 if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(data, "g int, a int, b double")
    types = {c: df.schema[c].dataType for c in "ab"}
    whole = im.group_lookups(df, "g", ["a", "b"], ["b"])
    parts = im.count_table(df.where("a > 2"), "g", "ab").unionByName(im.count_table(df.where("a is null or a <= 2"), "g", "ab"))
    added = im.lookups_from_counts(parts, types, {"b": types["b"]})
    assert rows(whole) == rows(added, *whole.columns)
    out = im.impute(df, "g", modes={"a": 1}, medians={"b": 7.0})
    assert out.count() == 200


def test_median_is_exact_in_large_groups(spark):
    df = spark.range(120_000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 120_011).cast("double").alias("v"))
    want = {g: sorted((i * 7919) % 120_011 for i in range(g, 120_000, 2))[29_999] for g in (0, 1)}
    assert {r.g: r.median_v for r in im.median_by_group(df, "g", "v").collect()} == want


def test_unicode_case_and_space(spark):
    from lakeshelf.functions.predicates import matches_ci
    df = spark.createDataFrame([("Élan",), ("DÜBENDORF",), ("\u00a0x\u3000",)], "t string")
    assert [r[0] for r in df.select(matches_ci("t", "éL")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(matches_ci("t", "düb")).collect()] == [False, True, False]
    assert cl.trim_strings(df, ["t"]).collect()[2][0] == "x"


def test_classify_without_a_model(spark):
    df = spark.createDataFrame([("عاجل سعر",), (None,)], "t string")
    assert [r[0] for r in df.select(al.classify("t")).collect()] == ["general", "general"]


def test_keyword_phrases_and_metacharacters(spark):
    from lakeshelf.functions.keywords import any_keyword
    df = spark.createDataFrame([("نريد موعد معاينة غدا",), ("price (approx.) 5$",), ("nothing",)], "t string")
    got = [r[0] for r in df.select(any_keyword("t", ["موعد معاينة", "(approx.)", "5$"])).collect()]
    assert got == [True, True, False]


def test_silver_dedup_keeps_latest_update(spark, sf):
    from lakeshelf.plans import silver
    from lakeshelf.plans.roles import raw_listings
    raw = raw_listings(spark, sf)
    again = raw.withColumn("updatedAt", F.col("updatedAt") + F.expr("INTERVAL 1 DAY")).withColumn("price", F.lit(1.0))
    out = silver.clean_listings(raw.unionByName(again), dedup=True)
    assert out.count() == raw.count()
    assert out.where(F.col("price") != 1.0).count() == 0


def test_silver_keeps_rows_without_a_usable_id(spark, sf):
    from lakeshelf.plans import silver
    from lakeshelf.plans.roles import raw_listings
    raw = raw_listings(spark, sf)
    bad = raw.withColumn("id", F.when(F.col("category") == 7, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    n = bad.where(F.col("id").startswith("x")).count()
    out = silver.clean_listings(bad, dedup=True)
    assert n > 0 and out.count() == raw.count() and out.where("row_id is null").count() == n
    assert cl.cast_rejects(bad, {"id": "bigint"}).first()[0] == n


def test_lookup_keeps_the_newest_row_over_loads(spark, tmp_path):
    path = f"file://{tmp_path}/lookup"
    row = lambda i, who, price, at: (i, who, "d", "c", "p", 1.0, price, at)
    cols = "row_id long, user_name string, district string, city string, property_type string, area double, price double, updated_at int"
    al.write_lookup(spark.createDataFrame([row(1, "Ahmed", 900.0, 1), row(2, "Sara", 5.0, 9), row(None, "none", 1.0, 1)], cols), path)
    al.write_lookup(spark.createDataFrame([row(1, "Zaid", 500.0, 2), row(2, "old", 1.0, 3)], cols), path)
    ev = spark.createDataFrame([("m", 1), ("n", 2), ("o", 3)], "msg_id string, listing_ref bigint")
    got = {r.msg_id: (r.user_name, r.price) for r in al.enrich(ev, al.Lookup(spark, path)).collect()}
    assert got == {"m": ("Zaid", 500.0), "n": ("Sara", 5.0)}
