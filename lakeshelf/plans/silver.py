"""The silver cleaning chain (bronze listing feed -> typed 28-column table)
as one composition of library operators.

Order of steps: typed projection -> category decode (code table) -> constant
fills -> group median (area) and group modes (nine columns), all looked up in
ONE aggregate and ONE join -> rent-period decode -> flags to Yes/No ->
ordered projection onto the silver schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators import cleaning as cl
from lakeshelf.operators import impute as im
from lakeshelf.operators import selection as sel
from lakeshelf.operators.dims import dedup_latest
from lakeshelf.operators.impute import impute
from lakeshelf.plans.roles import RENT_PERIODS
from lakeshelf.sources import runs, tiers
from lakeshelf.sources.io import code_table

# Category codes (fixed values): code, property type, transaction type.
CATEGORY_CODES = [
    (1, "Apartment", "Rental"), (2, "Land", "Sell"), (3, "Villa", "Sell"), (4, "Floor", "Rental"),
    (5, "Villa", "Rental"), (6, "Apartment", "Sell"), (7, "Building", "Sell"), (8, "Store", "Rental"),
    (9, "House", "Sell"), (10, "Esterahah", "Sell"), (11, "House", "Rental"), (12, "Farm", "Sell"),
    (13, "Esterahah", "Rental"), (14, "Office", "Rental"), (15, "Land", "Rental"),
    (16, "Building", "Rental"), (17, "Warehouse", "Rental"), (18, "Campsite", "Rental"),
    (19, "Room", "Rental"), (20, "Store", "Sell"), (21, "Furnished Apartment", "Rental"),
    (22, "Floor", "Sell"), (23, "Chalet", "Rental"),
]
CATEGORY_COLUMNS = ["category_id", "property_type", "transaction_type"]

# Columns imputed by group mode (default 1), and the one by group median (default 500).
MODE_COLUMNS = ["age", "air_condition", "bedrooms", "bathrooms", "rent_period", "kitchen",
                "is_furnished", "livings", "daily_rentable"]
MEDIAN_COLUMN = "area"
MODE_DEFAULT, MEDIAN_DEFAULT = 1, 500

# int flag column -> Yes/No text column
FLAG_RENAMES = {"user_iam_verified": "is_verified", "is_furnished": "has_furnished",
                "air_condition": "has_air_condition", "kitchen": "has_kitchen",
                "daily_rentable": "is_daily_rentable"}

SILVER_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("row_id", T.LongType()), ("user_id", T.LongType()), ("user_name", T.StringType()),
    ("advertiser_type", T.StringType()), ("is_verified", T.StringType()),
    ("user_review", T.FloatType()), ("city_id", T.LongType()), ("city", T.StringType()),
    ("district_id", T.LongType()), ("district", T.StringType()),
    ("property_type", T.StringType()), ("transaction_type", T.StringType()),
    ("location_lat", T.DecimalType(10, 5)), ("location_lng", T.DecimalType(10, 5)),
    ("create_time", T.TimestampNTZType()), ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()), ("age", T.IntegerType()),
    ("has_air_condition", T.StringType()), ("has_kitchen", T.StringType()),
    ("bathrooms", T.IntegerType()), ("bedrooms", T.IntegerType()), ("livings", T.IntegerType()),
    ("area", T.DoubleType()), ("has_furnished", T.StringType()), ("price", T.FloatType()),
    ("rent_period", T.StringType()), ("is_daily_rentable", T.StringType()),
]])

# raw key -> (silver name, type); every cast is tolerant
RAW_FIELDS = {
    "id": ("row_id", "bigint"), "user_id": ("user_id", "bigint"), "user.name": ("user_name", "string"),
    "user.iam_verified": ("user_iam_verified", "int"), "user.review": ("user_review", "float"),
    "location.lat": ("location_lat", "decimal(10,5)"), "location.lng": ("location_lng", "decimal(10,5)"),
    "create_time": ("create_time", "timestamp_ntz"), "createdAt": ("created_at", "timestamp_ntz"),
    "updatedAt": ("updated_at", "timestamp_ntz"), "age": ("age", "int"),
    "ac": ("air_condition", "int"), "ketchen": ("kitchen", "int"), "wc": ("bathrooms", "int"),
    "beds": ("bedrooms", "int"), "livings": ("livings", "int"), "furnished": ("is_furnished", "int"),
    "price": ("price", "float"), "rent_period": ("rent_period", "int"),
    "daily_rentable": ("daily_rentable", "int"), "district": ("district", "string"),
    "category": ("category", "int"), "area": ("area", "double"), "city": ("city", "string"),
    "advertiser_type": ("advertiser_type", "string"), "city_id": ("city_id", "bigint"),
    "district_id": ("district_id", "bigint"),
}


def typed_projection(raw: DataFrame) -> DataFrame:
    """Typed columns under their silver names; casts are tolerant and NaN
    becomes NULL, the only marker of a missing value from here on."""
    return cl.nan_to_null(cl.project(raw, {out: cl.try_cast_col(src, t) for src, (out, t) in RAW_FIELDS.items()}))


def latest_listings(typed: DataFrame) -> DataFrame:
    """One row per ``row_id`` (latest ``updated_at``; the whole row breaks
    ties). Rows without a usable id cannot be told apart: all of them stay,
    and ``cleaning.cast_rejects`` on the raw id counts them."""
    rest = [F.col(f"`{c}`") for c in typed.columns if c != "row_id"]
    known = dedup_latest(typed.where(F.col("row_id").isNotNull()), ["row_id"], [F.col("updated_at"), F.struct(*rest)])
    return known.unionByName(typed.where(F.col("row_id").isNull()))


def clean_listings(raw: DataFrame, group: str = "district", exact: bool = True,
                   dedup: bool = False, lookups: DataFrame | None = None) -> DataFrame:
    """The silver chain. ``dedup=True`` first keeps one row per listing
    (:func:`latest_listings`), for feeds that deliver a listing again when it
    is updated. ``lookups`` are group values from elsewhere, e.g. the whole
    history (:func:`run_silver`); without them they come from ``raw``.
    ``exact=False`` takes an approximate median."""
    df = typed_projection(raw)
    if dedup:
        df = latest_listings(df)
    return finish_listings(df, group, exact, lookups)


def finish_listings(df: DataFrame, group: str = "district", exact: bool = True,
                    lookups: DataFrame | None = None) -> DataFrame:
    """The chain after typing and de-duplication."""
    spark = df.sparkSession
    cats = code_table(spark, CATEGORY_CODES, CATEGORY_COLUMNS)
    # 23 literal rows: a proven size bound, so the broadcast is safe
    df = df.join(F.broadcast(cats), df["category"] == cats["category_id"], "left") \
           .drop("category_id", "category")
    df = cl.fill_const(df, {"user_review": 0, "advertiser_type": "N/A"})
    df = impute(df, group, modes={c: MODE_DEFAULT for c in MODE_COLUMNS},
                medians={MEDIAN_COLUMN: MEDIAN_DEFAULT}, exact=exact, lookups=lookups)
    df = cl.decode(df, "rent_period", RENT_PERIODS)
    df = cl.flags_to_text(df, FLAG_RENAMES)
    return cl.conform(df, SILVER_SCHEMA)


#: Bins of the median grid in a bucket of the stored values.
BINS_PER_BUCKET = 8
_COUNT_KEY = ("__grp", "__col", *im.VALUE_COLUMNS)


def add_history(typed: DataFrame, root: str, upto: int, group: str = "district") -> None:
    """Add a change set to the imputation history: ``mode_counts`` (how often
    each value of the mode columns occurs in a group), ``median_bins`` (how many
    values of the median column fall into each bin of the selection grid) and
    ``median_values`` (its counted values, in buckets of adjacent bins)."""
    def one(df):  # a small table: one bucket
        return df.withColumn(runs.BUCKET, F.lit(0))

    tiers.add(one(im.count_table(typed, group, MODE_COLUMNS)), f"{root}/mode_counts", upto, _COUNT_KEY)
    v = F.when(~F.isnan(MEDIAN_COLUMN), F.col(MEDIAN_COLUMN)).cast("double")
    values = typed.select(F.col(group).alias("__grp"), v.alias("__v")).where(F.col("__v").isNotNull())
    values = values.groupBy("__grp", "__v").agg(F.count(F.lit(1)).alias("__n"))
    bins = sel.histogram(values, weight="__n")
    tiers.add(one(bins), f"{root}/median_bins", upto, ("__grp", "__bin"))
    tiers.add(values.withColumn(runs.BUCKET, _bucket_of(sel.grid_bin(F.col("__v")))), f"{root}/median_values", upto, ("__grp", "__v"))


def _bucket_of(grid_bin):
    return F.floor(grid_bin / BINS_PER_BUCKET).cast("int")


def history_lookups(spark, root: str, types: dict, group_type: str = "string") -> DataFrame:
    """Group lookups over the whole history. The bin counts tell which bins
    hold a group's middle ranks; of the values only the buckets of those bins are
    read."""
    from lakeshelf.session import materialize
    counts = runs.read(spark, f"{root}/mode_counts", f"__grp {group_type}, __col string, __int bigint, __num double, __str string, __n bigint")
    modes = im.lookups_from_counts(counts, {c: types[c] for c in MODE_COLUMNS}, {})
    bins = runs.read(spark, f"{root}/median_bins", f"__grp {group_type}, __bin int, __n bigint")
    chosen = materialize(sel.middle_bins(bins.groupBy("__grp", "__bin").agg(F.sum("__n").alias("__n"))), "middle_bins")
    buckets = [r[0] for r in chosen.select(_bucket_of(F.col("__bin"))).distinct().collect()]  # at most the grid's buckets
    values = runs.read(spark, f"{root}/median_values", f"__grp {group_type}, __v double, __n bigint", buckets=buckets)
    median = sel.pick(chosen, values.withColumnRenamed("__n", "__c"), False, f"median_{MEDIAN_COLUMN}")
    return im.side_by_side(modes, median)


def run_silver(spark, bronze: str, root: str, until: int | None = None) -> bool:
    """One gated silver increment whose imputation sees the whole history.

    The rule: a run over bronze versions (since, until] imputes its rows from
    the group values of all rows of versions up to ``until``. They are kept as
    counts in tiers (:func:`add_history`), so no run reads old bronze rows, the
    number of stored runs grows with the logarithm of the increments, and of the
    nearly unique values of the median column a run reads the middle bins only.
    A group's lookup at a version does not depend on how the versions were batched
    (repeated deliveries within one run count once, as its newest row).
    Counts, rows and mark are written in this order, each run replaces only
    its own versions, and an unfinished run is finished first (its counts, if
    they are there already, are not added again)."""
    from lakeshelf.operators.facts import incremental_steps
    from lakeshelf.session import materialize
    from lakeshelf.sources import io

    def step(changes, since, upto):
        typed = materialize(latest_listings(typed_projection(changes)), "typed")
        add_history(typed, root, upto)
        lookups = history_lookups(spark, root, {c: typed.schema[c].dataType for c in MODE_COLUMNS})
        io.append_version(finish_listings(typed, lookups=lookups), f"{root}/silver", version=upto)

    return incremental_steps(spark, f"{root}/state", "silver_posts", bronze, step, until)


def clean_listings_sql(raw_sql: str, group: str = "district", history_sql: str | None = None) -> str:
    """The same chain as SQL text (used as the oracle); lookups come from
    ``history_sql``, by default the rows themselves."""
    def cast(src, t):
        e = f'TRY_CAST("{src}" AS {t.upper().replace("TIMESTAMP_NTZ", "TIMESTAMP")})'
        return f"CASE WHEN isnan({e}) THEN NULL ELSE {e} END" if t in ("float", "double") else e
    casts = ",\n  ".join(f"{cast(src, t)} AS {out}" for src, (out, t) in RAW_FIELDS.items())
    hist = "t" if history_sql is None else "h"
    values = ", ".join(f"({c}, '{p}', '{t}')" for c, p, t in CATEGORY_CODES)
    modes = "\n".join(
        f""", m_{c} AS (SELECT {group}, {c} AS v FROM (SELECT {group}, {c}, row_number() OVER (
  PARTITION BY {group} ORDER BY n DESC, {c}) AS r FROM (SELECT {group}, {c}, count(*) AS n FROM {hist}
  WHERE {c} IS NOT NULL GROUP BY {group}, {c}) f) WHERE r = 1)""" for c in MODE_COLUMNS)
    imputed = {c: f"coalesce(t.{c}, m_{c}.v, {MODE_DEFAULT})" for c in MODE_COLUMNS}
    imputed[MEDIAN_COLUMN] = f"coalesce(t.{MEDIAN_COLUMN}, md.v, {MEDIAN_DEFAULT})"
    joins = "\n".join(f"LEFT JOIN m_{c} ON t.{group} = m_{c}.{group}" for c in MODE_COLUMNS)

    def flag(e):
        return f"CASE WHEN {e} = 1 THEN 'Yes' WHEN {e} = 0 THEN 'No' END"
    rp = imputed["rent_period"]
    out = {
        "row_id": "t.row_id", "user_id": "t.user_id", "user_name": "t.user_name",
        "advertiser_type": "coalesce(t.advertiser_type, 'N/A')",
        "is_verified": flag("t.user_iam_verified"),
        "user_review": "coalesce(t.user_review, 0)", "city_id": "t.city_id", "city": "t.city",
        "district_id": "t.district_id", "district": "t.district",
        "property_type": "k.property_type", "transaction_type": "k.transaction_type",
        "location_lat": "t.location_lat", "location_lng": "t.location_lng",
        "create_time": "t.create_time", "created_at": "t.created_at", "updated_at": "t.updated_at",
        "age": imputed["age"], "has_air_condition": flag(imputed["air_condition"]),
        "has_kitchen": flag(imputed["kitchen"]), "bathrooms": imputed["bathrooms"],
        "bedrooms": imputed["bedrooms"], "livings": imputed["livings"], "area": imputed["area"],
        "has_furnished": flag(imputed["is_furnished"]), "price": "t.price",
        "rent_period": f"CASE WHEN {rp} IN (0, 3) THEN 'Yearly' WHEN {rp} = 1 THEN 'Daily' "
                       f"WHEN {rp} = 2 THEN 'Monthly' END",
        "is_daily_rentable": flag(imputed["daily_rentable"]),
    }
    sel = ",\n  ".join(f"{e} AS {n}" for n, e in out.items())
    h = "" if history_sql is None else f"h AS (SELECT {casts} FROM {history_sql} raw_h),\n"
    return f"""WITH t AS (SELECT {casts} FROM {raw_sql} raw),
{h}k0 AS (SELECT * FROM (VALUES {values}) v(category_id, property_type, transaction_type)),
md AS (SELECT {group}, quantile_disc({MEDIAN_COLUMN}, 0.5) AS v FROM {hist} GROUP BY {group}){modes}
SELECT {sel}
FROM t LEFT JOIN k0 k ON t.category = k.category_id
LEFT JOIN md ON t.{group} = md.{group}
{joins}"""
