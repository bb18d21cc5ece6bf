"""The gold star schema built from the silver listing table: six dimensions
and the fact, plus the per-city monthly report used as the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.operators import dims as dm
from lakeshelf.operators.facts import Lookup, resolve_keys
from lakeshelf.session import checked_broadcast, materialize, path_exists

# newest by update; creation and id break ties
LATEST = ["updated_at", "created_at", "row_id"]
USER_TRACKED = ["user_name", "advertiser_type", "is_verified"]
CATEGORY_KEYS = ["property_type", "transaction_type"]
FEATURE_KEYS = ["has_air_condition", "has_kitchen", "has_furnished", "is_daily_rentable", "rent_period"]
FACT_MEASURES = ["user_review", "location_lat", "location_lng", "age", "bathrooms", "bedrooms",
                 "livings", "area", "price"]


DIM_SCHEMAS = {
    "users": "id bigint, user_id bigint, user_name string, advertiser_type string, is_verified string, is_active int",
    "cities": "id bigint, city_id bigint, city string",
    "districts": "id bigint, district_id bigint, district string",
    "categories": "id bigint, property_type string, transaction_type string",
    "features": "id bigint, " + ", ".join(f"{k} string" for k in FEATURE_KEYS),
    "dates": "date_key int, date date, year int, month int, month_name string, quarter int, day_of_week int, is_weekend int",
}
#: natural key and attributes of the insert-only dimensions
INSERT_ONLY = {"cities": (["city_id"], ["city"]), "districts": (["district_id"], ["district"]),
               "categories": (CATEGORY_KEYS, []), "features": (FEATURE_KEYS, [])}


def _empty(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMAS[name])


def new_rows(name: str, stored: DataFrame, silver: DataFrame) -> DataFrame:
    """The rows that a change set adds to an insert-only dimension."""
    keys, attrs = INSERT_ONLY[name]
    return dm.upsert_dim(stored, silver.select(*keys, *attrs, *LATEST), keys, attrs, order=LATEST if attrs else None, only_new=True)


def new_dates(stored: DataFrame, silver: DataFrame) -> DataFrame:
    """Days that the calendar lacks to reach without a gap from the earliest
    to the latest day of the stored calendar and the change set."""
    span = (stored.select("date").unionByName(silver.select(F.to_date("created_at").alias("date")))
            .agg(F.min("date").alias("s"), F.max("date").alias("e")).where(F.col("s").isNotNull()))
    cal = dm.date_dim(silver.sparkSession, F.col("s"), F.col("e"), source=span)
    return cal.join(stored.select("date"), "date", "left_anti").select(*cal.columns)


def build_dims(silver: DataFrame, dims: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """One silver change set applied to dimensions held as DataFrames (empty
    ones when ``dims`` is None): the whole-table form, for a first build.
    Increments of stored dimensions are :func:`run_gold`."""
    spark = silver.sparkSession
    stored = {n: (dims or {}).get(n, _empty(spark, n)) for n in DIM_SCHEMAS}
    d = {"users": dm.scd2(stored["users"], silver.select("user_id", *USER_TRACKED, *LATEST), "user_id", USER_TRACKED, order=LATEST)}
    for n in INSERT_ONLY:
        d[n] = stored[n].unionByName(new_rows(n, stored[n], silver))
    d["dates"] = stored["dates"].unionByName(new_dates(stored["dates"], silver))
    return {k: materialize(v, f"dim_{k}") for k, v in d.items()}


def build_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """fact_posts: row_id, six surrogate/date keys, nine measures."""
    lookups = [
        Lookup(dims["users"], {"user_id": "user_id"}, "id", "user_sk", where=F.col("is_active") == 1),
        Lookup(dims["cities"], {"city_id": "city_id"}, "id", "city_sk"),
        Lookup(dims["districts"], {"district_id": "district_id"}, "id", "district_sk"),
        Lookup(dims["dates"], {"date": F.to_date("created_at")}, "date_key", "date_id"),
        Lookup(dims["categories"], {k: k for k in CATEGORY_KEYS}, "id", "category_id"),
        Lookup(dims["features"], {k: k for k in FEATURE_KEYS}, "id", "property_feature_id"),
    ]
    f = resolve_keys(silver, lookups, ["row_id", *FACT_MEASURES])
    # natural-key names for parity with the reference fact (they hold surrogates)
    return f.select("row_id", F.col("user_sk").alias("user_id"), F.col("city_sk").alias("city_id"),
                    F.col("district_sk").alias("district_id"), "date_id", "category_id",
                    "property_feature_id", *FACT_MEASURES)


def city_month_report(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Listings and average price per city and calendar month."""
    cities = dims["cities"].select(F.col("id").alias("city_id"), "city")
    dates = dims["dates"].select(F.col("date_key").alias("date_id"), "year", "month")
    j = fact.join(checked_broadcast(cities), "city_id", "left").join(checked_broadcast(dates), "date_id", "left")
    return (j.groupBy("city", "year", "month")
             .agg(F.count(F.lit(1)).alias("listings"), F.round(F.avg("price"), 2).alias("avg_price")))


def read_dim(spark, root: str, name: str, upto: int) -> DataFrame:
    """A stored dimension as of version ``upto``: the versions of an
    insert-only one add up; users are the current history."""
    from lakeshelf.sources import io

    path = f"{root}/dim_{name}"
    if name == "users":
        return dm.read_dim(spark, path, DIM_SCHEMAS[name])
    if not path_exists(spark, path):
        return _empty(spark, name)
    t = spark.read.parquet(path)
    return t.where(F.col(io.VERSION) <= upto).drop(io.VERSION)


def run_gold(spark, silver_versions: str, root: str, until: int | None = None) -> bool:
    """One gated gold increment over the versioned silver table at a path.

    current silver version -> last gold mark -> gate -> changes in
    (last, current] -> dimensions -> fact, appended as version ``current`` ->
    mark. Insert-only dimensions and the calendar get their new rows as
    version ``current``; users get new runs of the hash buckets that the changes
    touch, shown by one published state (applying a change set twice changes
    nothing), and runs that the last three states don't list are deleted.
    Nothing copies a whole dimension. After a failure the recorded range is finished
    first; it reads the dimensions as of the last mark and replaces its own
    versions."""
    from lakeshelf.operators.facts import incremental_steps
    from lakeshelf.sources import io, runs

    def step(changes, since, upto):
        changes = materialize(changes.drop(io.VERSION), "changes")  # read by every dimension
        dm.scd2_in_place(f"{root}/dim_users", changes.select("user_id", *USER_TRACKED, *LATEST), "user_id", USER_TRACKED,
                         DIM_SCHEMAS["users"], order=LATEST)
        for n in (*INSERT_ONLY, "dates"):
            stored = read_dim(spark, root, n, since)
            # the table that is extended is being read: new days are written aside
            # first (new rows of the others already were, to number them)
            new = materialize(new_dates(stored, changes), "new_dates") if n == "dates" else new_rows(n, stored, changes)
            io.append_version(new, f"{root}/dim_{n}", version=upto)
        dims = {n: read_dim(spark, root, n, upto) for n in DIM_SCHEMAS}
        io.append_version(build_fact(changes, dims), f"{root}/fact_posts", version=upto)
        runs.retire(spark, f"{root}/dim_users", keep=3)

    return incremental_steps(spark, f"{root}/state", "fact_posts", silver_versions, step, until)
