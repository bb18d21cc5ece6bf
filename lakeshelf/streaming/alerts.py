"""Interaction stream: projection, keyword + sentiment classification,
enrichment from the listing table, routing of alerts to channels, and an
idempotent per-micro-batch sink.

Classification is a ``when`` chain over JVM-side regex matches (one
alternation per keyword list), so it stays in whole-stage codegen. A
sentiment model is optional: :func:`sentiment_udf` wraps any batch scorer
in an iterator pandas UDF (Arrow batches, one model load per Python worker)
that returns ``struct<label, score>``.
"""

from __future__ import annotations

import contextlib
import functools
import json
from dataclasses import dataclass
from typing import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.functions.keywords import any_keyword
from lakeshelf.session import checked_broadcast, materialize, path_exists, scratch_scope
from lakeshelf.sources import commits, runs
from lakeshelf.sources.io import VERSION

# Default keyword lists (fixed values), matched as substrings of the lower-cased text.
URGENT_WORDS = ["صيانة", "تسريب", "خربان", "عاجل", "عاجلة", "مشكلة", "الحقوا", "خلل", "مكسور"]
SALES_WORDS = ["سعر", "كم", "تقسيط", "الدعم السكني", "موعد معاينة", "طريقة الدفع", "حجز", "متاح", "التسليم"]
INTENT_WORDS = ["أريد", "اريد", "أود", "عايز"]
NEGATIVE = "negative"
COMPLAINT_SCORE = 0.85
URGENT, SALES, COMPLAINT, GENERAL = "urgent", "sales_lead", "complaint", "general"
ROUTED = (URGENT, SALES)

INTERACTION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("listing_ref", T.StringType()),
    T.StructField("comment", T.StringType()), T.StructField("phone_number", T.StringType()),
    T.StructField("_ts", T.LongType())])


def project_interactions(df: DataFrame) -> DataFrame:
    """id -> msg_id, listing_ref -> bigint (tolerant), _ts (epoch seconds) ->
    event_time."""
    return df.select(
        F.col("id").alias("msg_id"), F.col("listing_ref").try_cast("bigint").alias("listing_ref"),
        "phone_number", "comment",
        F.timestamp_seconds(F.col("_ts")).cast("timestamp_ntz").alias("event_time"))


def classify(text: str | Column, label: str | Column | None = None, score: str | Column | None = None,
             urgent: Iterable[str] = URGENT_WORDS, sales: Iterable[str] = SALES_WORDS,
             intent: Iterable[str] = INTENT_WORDS, threshold: float = COMPLAINT_SCORE) -> Column:
    """Ordered rules, given the label and score of a sentiment model:
    1. any urgent word -> urgent;
    2. (any sales word and the label is not negative) or any intent word -> sales_lead;
    3. negative label with score above ``threshold`` -> complaint;
    4. general.
    Without a model (``label`` is None) every message is general. A NULL text
    matches no word; a NULL label counts as not negative."""
    if label is None:
        return F.lit(GENERAL)
    lab = F.col(label) if isinstance(label, str) else label
    sc = F.lit(None).cast("double") if score is None else (F.col(score) if isinstance(score, str) else score)
    not_neg = F.coalesce(F.lower(lab) != NEGATIVE, F.lit(True))
    neg_conf = F.coalesce((F.lower(lab) == NEGATIVE) & (sc > threshold), F.lit(False))
    return (F.when(any_keyword(text, urgent), F.lit(URGENT))
             .when((any_keyword(text, sales) & not_neg) | any_keyword(text, intent), F.lit(SALES))
             .when(neg_conf, F.lit(COMPLAINT))
             .otherwise(F.lit(GENERAL)))


def sentiment_udf(load_model: Callable[[], Callable[[list], list]]):
    """Iterator pandas UDF ``text -> struct<label string, score double>``.

    ``load_model()`` runs once per Python worker and returns a function
    mapping a list of texts to a list of (label, score) pairs. Texts arrive
    in Arrow batches; NULL texts are passed as empty strings."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("label string, score double")
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for s in batches:
            res = model(s.fillna("").tolist())
            yield pd.DataFrame({"label": [r[0] for r in res], "score": [float(r[1]) for r in res]})

    return _score


LOOKUP_COLUMNS = ("user_name", "district", "city", "property_type", "area", "price")
LOOKUP_ORDER = ("updated_at", VERSION)
#: Rows that a bucket of the lookup holds at its first load.
BUCKET_ROWS = 500_000


def newest_listings(listings: DataFrame, key: str = "row_id", order: Sequence[str] = LOOKUP_ORDER) -> DataFrame:
    """One row per listing: the newest by those of the ``order`` columns that
    the table has (the whole row breaks ties)."""
    rest = [c for c in listings.columns if c != key]
    by = [c for c in order if c in rest]
    last = F.max_by(F.struct(*rest), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*by, *rest])]))
    return listings.groupBy(key).agg(last.alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def write_lookup(listings: DataFrame, path: str, key: str = "row_id", columns: Sequence[str] = LOOKUP_COLUMNS,
                 order: Sequence[str] = LOOKUP_ORDER, buckets: int | None = None) -> runs.State:
    """Load listings, or changes of them, into the lookup of the alert stream:
    the newest row of each listing, with the columns that alerts need, becomes a
    run in the hash buckets of the key. Nothing that is stored is read or
    rewritten, so a load costs its own size, and streams read on meanwhile. The
    first load fixes the number of buckets by its rows (at least 16)."""
    spark = listings.sparkSession
    have = [c for c in order if c in listings.columns and c not in columns]
    new = newest_listings(listings.select(key, *columns, *have).where(F.col(key).isNotNull()), key, order)
    with scratch_scope(spark):
        new = materialize(new, "lookup")
        info = runs.newest(spark, path).info
        if not info:
            info = {"key": key, "order": [c for c in order if c in new.columns], "schema": new.schema.json(),
                    "buckets": buckets or max(16, 1 << (new.count() // BUCKET_ROWS).bit_length())}
        return runs.append(runs.with_bucket(new, [key], info["buckets"]), path, info)


def compact_lookup(spark: SparkSession, path: str, runs_at_least: int = 4, keep: int = 2) -> list[int]:
    """Merge the buckets that hold ``runs_at_least`` runs or more into one run
    of newest rows each, then delete the runs that neither the last ``keep``
    states nor a reading batch needs. Loads may go on: their runs stay on top
    of the merged one. Returns the merged buckets."""
    state = runs.newest(spark, path)
    full = [b for b, r in state.runs.items() if len(r) >= runs_at_least]
    if full:
        rows = runs.read(spark, path, T.StructType.fromJson(json.loads(state.info["schema"])), state, full)
        one = newest_listings(rows, state.info["key"], state.info["order"])
        runs.replace(runs.with_bucket(one, [state.info["key"]], state.info["buckets"]), path, state, full)
    runs.retire(spark, path, keep)
    return sorted(full)


@dataclass(frozen=True)
class Lookup:
    """A lookup as :func:`write_lookup` keeps it."""
    spark: SparkSession
    path: str

    def matching(self, refs: DataFrame, ref: str) -> DataFrame:
        """The newest row of each listing that ``refs`` names: only their
        buckets are read, of a state that stays while the batch runs."""
        state = runs.pin(self.spark, self.path)
        if state.number < 0:
            raise FileNotFoundError(f"no lookup at {self.path}")
        key, schema = state.info["key"], T.StructType.fromJson(json.loads(state.info["schema"]))
        wanted = refs.select(F.col(ref).cast(schema[key].dataType).alias(key)).where(F.col(key).isNotNull()).distinct()
        wanted = materialize(runs.with_bucket(wanted, [key], state.info["buckets"]), "lookup_refs")
        touched = [r[0] for r in wanted.select(runs.BUCKET).distinct().collect()]  # at most as many ints as buckets
        rows = runs.read(self.spark, self.path, schema, state, touched)
        if any(len(state.runs.get(b, [])) > 1 for b in touched):  # else each listing has one row
            rows = rows.join(checked_broadcast(wanted.select(key), stored=True), key, "left_semi")
            rows = newest_listings(rows, key, state.info["order"])
        return rows.withColumnRenamed(key, "__key")


def enrich(events: DataFrame, listings: DataFrame | Lookup, key: str = "row_id", ref: str = "listing_ref") -> DataFrame:
    """Inner join of a batch of interactions to listings on ``ref = key``.

    Of a stored :class:`Lookup` only the buckets that the batch refers to are
    read; if the batch's measured size is small it is broadcast, so no listing
    is shuffled. Any other listing table is first reduced to its newest rows."""
    if isinstance(listings, Lookup):
        one = listings.matching(events, ref)
        one = one.drop(*[c for c in LOOKUP_ORDER if c not in events.columns])
        return one.join(checked_broadcast(events), F.col(ref) == F.col("__key"), "inner").drop("__key")
    one = newest_listings(listings, key)
    return events.join(one, events[ref] == one[key], "inner").drop(one[key])


def route(df: DataFrame, cls: str = "ai_analysis") -> DataFrame:
    """Keep urgent and sales_lead rows; add ``channel`` and the rendered
    ``message`` (urgent omits area and price, sales includes them)."""
    def line(label, c):
        return F.concat(F.lit(label + ": "), F.coalesce(F.col(c).cast("string"), F.lit("N/A")))
    common_head = [line("Customer phone", "phone_number"), line("Owner", "user_name")]
    tail = [line("City", "city"), line("District", "district"), line("Message", "comment"),
            line("Time", "event_time")]
    urgent_msg = F.concat_ws("\n", F.lit("URGENT (maintenance)"), F.lit("------------------"),
                             *common_head, *tail)
    def whole(label, c):  # integer part, so the text does not depend on float printing
        return F.concat(F.lit(label + ": "), F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("N/A")))
    sales_msg = F.concat_ws("\n", F.lit("New sales lead"), F.lit("------------------"), *common_head,
                            whole("Area", "area"), whole("Price", "price"), *tail)
    c = F.col(cls)
    return (df.where(c.isin(*ROUTED))
              .withColumn("channel", F.when(c == URGENT, F.lit("urgent_group")).otherwise(F.lit("sales_group")))
              .withColumn("message", F.when(c == URGENT, urgent_msg).otherwise(sales_msg)))


ALERT_COLUMNS = ["msg_id", "ai_analysis", "channel", "message", "comment", "event_time", "phone_number",
                 "user_name", "district", "city", "property_type", "area", "price"]


def alert_pipeline(events: DataFrame, listings: DataFrame | Lookup, label: str | None = None,
                   score: str | None = None, words: dict | None = None) -> DataFrame:
    """project -> enrich (join first: unmatched events are never scored) ->
    classify -> route."""
    words = words or {}
    e = enrich(events, listings)
    e = e.withColumn("ai_analysis", classify("comment", label, score, **words))
    return route(e).select(*ALERT_COLUMNS)


def read_interactions(spark: SparkSession, path: str, schema: T.StructType = INTERACTION_SCHEMA,
                      fmt: str = "parquet", max_files: int | None = None, **options) -> DataFrame:
    """Streaming source with an explicit schema; ``max_files`` bounds each
    micro-batch (the per-trigger item limit)."""
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


_COMMITS = "_commits"
#: The folder name of a row's batch, of what :func:`read_batches` returns.
BATCH = "element_at(split(_metadata.file_path, '/'), -2)"


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings inside the ``with`` block; what is set already stays."""
    new = {k: v for k, v in values.items() if spark.conf.get(k, None) is None}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in new:
            spark.conf.unset(k)


def _checkpoint_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Settings for a query that is started with them (it copies the session's).
    Without Hadoop's native library, a checkpoint file on a local file system
    costs a process for each link that is looked up and each permission that is
    set; Spark's writer on ``FileSystem`` needs fewer. There, both of its writers
    look for the file and then rename. Elsewhere nothing is changed."""
    if not commits.is_local(spark, path):
        return {}
    return {"spark.sql.streaming.checkpointFileManagerClass":
            "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}


def write_batches(stream: DataFrame, make: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                  trigger: dict | None = None, once: bool = False):
    """Start a query that writes ``make(batch)`` of each micro-batch to a folder
    of its own below ``out``, named by the query's id (which its checkpoint
    keeps) and the batch's. The folder counts once its commit file is there:
    a batch that is replayed after that is not written again, one that failed
    before is written anew, and a new checkpoint, whose batch ids start again,
    has another query id. Read the output with :func:`read_batches`.

    The batch is written to the shared scratch folder once, as ``make`` may
    read it several times, and deleted after; with ``once``, ``make`` reads it
    only once, straight from the source. States of tables that ``make``
    reads (:func:`lakeshelf.sources.runs.pin`) stay until the batch is written."""
    spark, out = stream.sparkSession, out.rstrip("/")

    @functools.cache
    def query() -> str:
        return json.loads(commits.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]

    def sink(batch: DataFrame, batch_id: int):
        name = f"{query()}~{batch_id:012d}"
        if path_exists(spark, f"{out}/{_COMMITS}/{name}"):
            return
        with scratch_scope(spark), runs.reading():
            rows = make(batch if once else materialize(batch, "batch"))
            rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{out}/{name}")
        commits.create_exclusive(spark, f"{out}/{_COMMITS}/{name}", rows.schema.json())

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _settings(spark, _checkpoint_files(spark, checkpoint)):
        return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def committed_batches(spark: SparkSession, out: str) -> list[str]:
    """Folder names of the committed batches of an output, in order."""
    return sorted(n for n, _ in commits.names_in(spark, f"{out.rstrip('/')}/{_COMMITS}") if n[0] != ".")


def read_batches(spark: SparkSession, out: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of all committed batches. ``schema`` is needed only where no
    batch may have been committed yet. :data:`BATCH` is the batch of a row."""
    out = out.rstrip("/")
    names = committed_batches(spark, out)
    if not names:
        if schema is None:
            raise FileNotFoundError(f"no committed batch in {out}")
        return spark.createDataFrame([], schema)
    if schema is None:
        schema = T.StructType.fromJson(json.loads(commits.read_text(spark, f"{out}/{_COMMITS}/{names[-1]}")))
    # Spark lists the folders in a job with a task for each, up to this number
    tasks = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    with _settings(spark, tasks):
        return spark.read.schema(schema).parquet(*[f"{out}/{n}" for n in names])


def write_alerts(stream: DataFrame, listings_loader: Callable[[], DataFrame | Lookup], out: str, checkpoint: str,
                 trigger: dict | None = None, label: str | None = None, score: str | None = None,
                 words: dict | None = None):
    """Start the alert query: each micro-batch is enriched against a fresh
    read of the lookup (``listings_loader``), classified, routed and written
    (:func:`write_batches`)."""
    return write_batches(stream, lambda batch: alert_pipeline(batch, listings_loader(), label, score, words), out, checkpoint, trigger)


def run_available(query, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query to finish, however long its backlog
    takes; with ``timeout_s``, stop it and raise after that time."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError("stream did not finish in time")
    if query.exception() is not None:
        raise query.exception()
