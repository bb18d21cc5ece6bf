"""Streaming queries. ``events`` plays the interaction feed (listing_ref =
event id, comment = event type + props, sentiment from the value); the
listing table is the static side. Streams run with ``availableNow`` into
the scratch folder and the written result is returned."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import LISTINGS_SQL, listings
from lakeshelf.session import is_folder, read_table, scratch_path, table_path
from lakeshelf.sources import io
from lakeshelf.streaming import admission as adm
from lakeshelf.streaming import alerts as al

EVENT_WORDS = {"urgent": ["error"], "sales": ["purchase", "signup"], "intent": ['"k": 7']}
CONV_WORDS = {"urgent": ["entre", "pas"], "sales": ["tion", "elle"], "intent": ["oui"]}
LISTING_COLS = ["row_id", *al.LOOKUP_COLUMNS, "updated_at", io.VERSION]


def _versions(spark, sf):
    """The listing table with earlier states: every third listing was first
    delivered by another user at half the price."""
    li = listings(spark, sf).withColumn("updated_at", F.col("created_at"))
    old = li.where(F.col("row_id") % 3 == 0).withColumns({
        "user_name": F.lit("Zz former owner"), "price": F.col("price") / 2,
        "updated_at": F.col("updated_at") - F.expr("interval 3 days"), io.VERSION: F.lit(0)})
    return old.unionByName(li).select(*LISTING_COLS)


def _lookup(spark, sf):
    """The stored lookup after two loads: the earlier states, then the rest."""
    path = scratch_path(spark, "lookup")
    v = _versions(spark, sf)
    al.write_lookup(v.where(F.col("user_name") == "Zz former owner"), path)
    al.write_lookup(v.where(F.col("user_name") != "Zz former owner"), path)
    return al.Lookup(spark, path)


VERSIONS_SQL = f"""(SELECT row_id, user_name, district, city, property_type, area, price, created_at AS updated_at, _commit_version
FROM {LISTINGS_SQL} v1 UNION ALL
SELECT row_id, 'Zz former owner', district, city, property_type, area, price / 2, created_at - INTERVAL 3 DAY, 0
FROM {LISTINGS_SQL} v2 WHERE row_id % 3 = 0)"""
NEWEST_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id
  ORDER BY updated_at DESC, _commit_version DESC) AS rn FROM {VERSIONS_SQL} v) WHERE rn = 1)"""


def _interactions(df):
    """events -> interaction feed shape (id, listing_ref, comment, phone, _ts) + label/score."""
    return df.select(
        F.col("event_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("listing_ref"),
        F.concat_ws(" ", "event_type", "props").alias("comment"),
        F.concat(F.lit("05"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("phone_number"),
        F.col("ts").cast("timestamp").cast("long").alias("_ts"),
        F.when(F.col("value") < 50, "negative").otherwise("positive").alias("label"),
        (F.col("value") / 500).alias("score"))


def _projected(df):
    """T1 projection keeping the scorer columns."""
    return df.select(
        F.col("id").alias("msg_id"), F.col("listing_ref").try_cast("bigint").alias("listing_ref"),
        "phone_number", "comment",
        F.timestamp_seconds(F.col("_ts")).cast("timestamp_ntz").alias("event_time"), "label", "score")


def _event_stream(spark, sf):
    """The table as a stream: the part files of its folder, or its only file."""
    schema = read_table(spark, sf, "events").schema
    if is_folder(spark, path := table_path(sf, "events")):
        return al.read_interactions(spark, path, schema=schema, max_files=1)
    return al.read_interactions(spark, sf, schema=schema, max_files=1, pathGlobFilter="events.parquet")


EV_SQL = """(SELECT CAST(event_id AS VARCHAR) AS msg_id, CAST(event_id AS BIGINT) AS listing_ref,
  '05' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS phone_number, event_type || ' ' || props AS comment,
  make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS event_time,
  CASE WHEN value < 50 THEN 'negative' ELSE 'positive' END AS label, value / 500 AS score FROM events)"""


def _classify_sql(words, text="comment"):
    c = lambda ws: "(" + " OR ".join(f"contains(lower({text}), '{w}')" for w in ws) + ")"
    return f"""CASE WHEN {c(words['urgent'])} THEN 'urgent'
  WHEN ({c(words['sales'])} AND coalesce(lower(label) <> 'negative', true)) OR {c(words['intent'])} THEN 'sales_lead'
  WHEN coalesce(lower(label) = 'negative' AND score > 0.85, false) THEN 'complaint' ELSE 'general' END"""


def _line(label, e):
    return f"'{label}: ' || coalesce(CAST({e} AS VARCHAR), 'N/A')"


ROUTE_SQL = f"""WITH ev AS {EV_SQL},
j AS (SELECT ev.*, li.user_name, li.district, li.city, li.property_type, li.area, li.price
      FROM ev JOIN {NEWEST_SQL} li ON ev.listing_ref = li.row_id),
c AS (SELECT *, {_classify_sql(EVENT_WORDS)} AS ai_analysis FROM j)
SELECT msg_id, ai_analysis, CASE WHEN ai_analysis = 'urgent' THEN 'urgent_group' ELSE 'sales_group' END AS channel,
  CASE WHEN ai_analysis = 'urgent' THEN concat_ws(chr(10), 'URGENT (maintenance)', '------------------',
      {_line('Customer phone', 'phone_number')}, {_line('Owner', 'user_name')}, {_line('City', 'city')},
      {_line('District', 'district')}, {_line('Message', 'comment')}, {_line('Time', 'event_time')})
  ELSE concat_ws(chr(10), 'New sales lead', '------------------',
      {_line('Customer phone', 'phone_number')}, {_line('Owner', 'user_name')},
      {_line('Area', 'CAST(trunc(area) AS BIGINT)')}, {_line('Price', 'CAST(trunc(price) AS BIGINT)')},
      {_line('City', 'city')}, {_line('District', 'district')}, {_line('Message', 'comment')},
      {_line('Time', 'event_time')}) END AS message,
  comment, event_time, phone_number, user_name, district, city, property_type, area, price
FROM c WHERE ai_analysis IN ('urgent', 'sales_lead')"""


@query("stream_ingest", f"SELECT msg_id, listing_ref, phone_number, comment, event_time FROM {EV_SQL} e")
def q_stream_ingest(spark, sf):
    out, ck = scratch_path(spark, "ingest_out"), scratch_path(spark, "ingest_ckpt")
    s = al.project_interactions(_interactions(_event_stream(spark, sf)))
    q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
          .trigger(availableNow=True).start())
    al.run_available(q)
    return spark.read.parquet(out)


@query("stream_enrich", f"""
SELECT e.msg_id, e.listing_ref, l.user_name, l.city, l.district, l.price
FROM {EV_SQL} e JOIN {NEWEST_SQL} l ON e.listing_ref = l.row_id""")
def q_stream_enrich(spark, sf):
    """Each micro-batch reads the lookup buckets that it refers to."""
    out, ck = scratch_path(spark, "enrich_out"), scratch_path(spark, "enrich_ckpt")
    lookup = _lookup(spark, sf)
    s = al.project_interactions(_interactions(_event_stream(spark, sf)))
    q = al.write_batches(s, lambda batch: al.enrich(batch, lookup), out, ck, {"availableNow": True})
    al.run_available(q)
    return al.read_batches(spark, out).select("msg_id", "listing_ref", "user_name", "city", "district", "price")


@query("stream_enrich_while_loading", f"""
SELECT e.msg_id, e.listing_ref, CASE WHEN old THEN 'Zz former owner' ELSE l.user_name END AS user_name, l.city,
  CASE WHEN old THEN l.price / 2 ELSE l.price END AS price
FROM (SELECT *, listing_ref % 3 = 0 AND (CAST(floor(listing_ref / 3) AS BIGINT) % 3 = 0
        OR (CAST(floor(listing_ref / 3) AS BIGINT) % 3 = 1 AND listing_ref % 2 = 1)) AS old FROM {EV_SQL} x) e
JOIN {LISTINGS_SQL} l ON e.listing_ref = l.row_id""")
def q_stream_enrich_while_loading(spark, sf):
    """Three micro-batches with loads between planning and writing each: batch
    k sees the rows of loads 0 to k, although the next load, a compaction and
    the deletion of old runs come before it is written."""
    top = scratch_path(spark, "loading")
    v = _versions(spark, sf)
    former, later = F.col("user_name") == "Zz former owner", F.col("row_id") % 3 == 0
    loads = [v.where(former | ~later), v.where(~former & later & (F.col("row_id") % 2 == 0)), v.where(~former & later & (F.col("row_id") % 2 == 1))]
    lookup = al.Lookup(spark, f"{top}/lookup")
    al.write_lookup(loads[0], lookup.path)
    ev = _interactions(read_table(spark, sf, "events"))
    for k in range(3):  # one file after the other: a micro-batch each
        part = ev.where(F.floor(F.col("listing_ref").cast("long") / 3) % 3 == k)
        part.coalesce(1).write.mode("append").parquet(f"{top}/feed")
    done = []

    def make(batch):
        rows = al.enrich(al.project_interactions(batch), lookup)
        done.append(1)
        if len(done) < 3:
            al.write_lookup(loads[len(done)], lookup.path)
            al.compact_lookup(spark, lookup.path, runs_at_least=2, keep=1)
        return rows

    feed = al.read_interactions(spark, f"{top}/feed", schema=ev.schema, max_files=1)
    al.run_available(al.write_batches(feed, make, f"{top}/out", f"{top}/ckpt", {"availableNow": True}))
    return al.read_batches(spark, f"{top}/out").select("msg_id", "listing_ref", "user_name", "city", "price")


@query("route_alerts", ROUTE_SQL)
def q_route_alerts(spark, sf):
    """Batch twin of the alert stream, on the listing table itself."""
    ev = _projected(_interactions(read_table(spark, sf, "events")))
    return al.alert_pipeline(ev, _versions(spark, sf), "label", "score", EVENT_WORDS)


@query("stream_route", ROUTE_SQL)
def q_stream_route(spark, sf):
    out, ck = scratch_path(spark, "alerts_out"), scratch_path(spark, "alerts_ckpt")
    lookup = _lookup(spark, sf)
    s = _projected(_interactions(_event_stream(spark, sf)))
    q = al.write_alerts(s, lambda: lookup, out, ck,
                        trigger={"availableNow": True}, label="label", score="score", words=EVENT_WORDS)
    al.run_available(q)
    return al.read_batches(spark, out)


@query("stream_route_bounded", ROUTE_SQL)
def q_stream_route_bounded(spark, sf):
    """The alert stream at its default trigger (every 5 seconds), stopped once
    the source is used up."""
    out, ck = scratch_path(spark, "alerts_b_out"), scratch_path(spark, "alerts_b_ckpt")
    lookup = _lookup(spark, sf)
    s = _projected(_interactions(_event_stream(spark, sf)))
    q = al.write_alerts(s, lambda: lookup, out, ck, label="label", score="score", words=EVENT_WORDS)
    q.processAllAvailable()
    q.stop()
    return al.read_batches(spark, out)


@query("classify_no_model", "SELECT conv_id, turn, 'general' AS ai_analysis FROM conversations")
def q_classify_no_model(spark, sf):
    """Without a sentiment model every message is general."""
    return read_table(spark, sf, "conversations").select("conv_id", "turn", al.classify("text", **CONV_WORDS).alias("ai_analysis"))


CONV_LABEL = "CASE WHEN (conv_id + turn) % 3 = 0 THEN 'negative' ELSE 'positive' END"
CONV_SCORE = "((conv_id * 7 + turn) % 100) / 100.0"


@query("classify_text", f"""
SELECT conv_id, turn, role, {_classify_sql(CONV_WORDS, 'text')} AS ai_analysis FROM (
  SELECT *, {CONV_LABEL} AS label, {CONV_SCORE} AS score FROM conversations) x""")
def q_classify_text(spark, sf):
    cv = read_table(spark, sf, "conversations")
    cv = cv.withColumns({"label": F.expr(CONV_LABEL), "score": F.expr(CONV_SCORE)})
    return cv.select("conv_id", "turn", "role",
                     al.classify("text", "label", "score", **CONV_WORDS).alias("ai_analysis"))


def _lexicon_model():
    """A tiny stand-in sentiment model (loaded once per worker)."""
    def model(texts):
        return [("negative", 0.9) if "non" in t.lower() else ("positive", 0.6) for t in texts]
    return model


@query("classify_scored", f"""
SELECT conv_id, turn, {_classify_sql(CONV_WORDS, 'text')} AS ai_analysis FROM (
  SELECT *, CASE WHEN contains(lower(text), 'non') THEN 'negative' ELSE 'positive' END AS label,
         CASE WHEN contains(lower(text), 'non') THEN 0.9 ELSE 0.6 END AS score FROM conversations) x""")
def q_classify_scored(spark, sf):
    """Sentiment from a pandas-UDF scorer (Arrow batches), rules JVM-side."""
    cv = read_table(spark, sf, "conversations")
    scorer = al.sentiment_udf(_lexicon_model)
    s = cv.select("conv_id", "turn", "text", scorer(F.col("text")).alias("s"))
    return s.select("conv_id", "turn", al.classify("text", "s.label", "s.score", **CONV_WORDS).alias("ai_analysis"))


ADMITTED_ROWS = 4000
#: Batches that a stream is to have before a further one takes a share of them.
LANE_BATCHES = 50


@query("stream_admission", f"SELECT msg_id, listing_ref, phone_number, comment, event_time, true AS admitted FROM {EV_SQL} e")
def q_stream_admission(spark, sf):
    """Batches of at most 4000 interactions; every stream is stopped after its
    first batches and started again. A large backlog is shared by streams that
    run side by side. ``admitted``: the message's batch kept the limit."""
    events = read_table(spark, sf, "events")
    out, ckpt, progress = (scratch_path(spark, n) for n in ("admitted", "ckpt", "progress"))
    lanes = max(1, min(spark.sparkContext.defaultParallelism, events.count() // (ADMITTED_ROWS * LANE_BATCHES)))

    def run(wait):
        streams = adm.read_lanes(spark, table_path(sf, "events"), events.schema, progress, rows=ADMITTED_ROWS, lanes=lanes)
        with contextlib.ExitStack() as stops:
            qs = []
            for k, s in enumerate(streams):
                rows = _projected(_interactions(s)).select("msg_id", "listing_ref", "phone_number", "comment", "event_time")
                qs.append(al.write_batches(rows, lambda batch: batch, out, f"{ckpt}/{k}", {"processingTime": "0 seconds"}, once=True))
                stops.callback(qs[-1].stop)
            wait(qs)

    def first_batches(qs):
        while all(q.isActive for q in qs) and len({n.split("~")[0] for n in al.committed_batches(spark, out)}) < len(qs):
            qs[0].awaitTermination(0.1)

    def all_batches(qs):
        for q in qs:
            q.processAllAvailable()

    run(first_batches)
    run(all_batches)
    rows = al.read_batches(spark, out).withColumn("batch", F.expr(al.BATCH))
    sizes = rows.groupBy("batch").agg((F.count(F.lit(1)) <= ADMITTED_ROWS).alias("admitted"))  # a row for each batch
    return rows.join(sizes, "batch").drop("batch")
