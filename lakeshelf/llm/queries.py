"""The registered queries of this package: each applies its operator with
production parameters to its whole table and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, read_table
from . import (
    common, decontaminate, hyperminhash, licenses, packing, pii, prefix_trie, quality_model, quality_rules, repeats, simhash,
    turn_repair, url_trust, wavelet,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op1_packing")
def op1(spark, sf_dir):
    pieces = packing.pieces(read_table(spark, sf_dir, "documents"))
    narrow = materialize(pieces.select("item", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_pii")
def op2(spark, sf_dir):
    found = pii.find(read_table(spark, sf_dir, "documents"))
    joined = lambda c: F.concat_ws(",", F.transform(
        c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op3_quality_model")
def op3(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    weights = quality_model.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_model.score(docs, weights).select(
        "doc_id", (common.crc32_of_id() % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_url_trust")
def op4(spark, sf_dir):
    return url_trust.judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op5_simhash")
def op5(spark, sf_dir):
    near = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_wavelet")
def op6(spark, sf_dir):
    back = wavelet.round_trip(read_table(spark, sf_dir, "documents"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_quality_rules")
def op7(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rules = quality_rules.learn_from_labels(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_repeats")
def op8(spark, sf_dir):
    out = repeats.remove_repeats(read_table(spark, sf_dir, "documents"), min_len=200)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_licenses")
def op9(spark, sf_dir):
    found = licenses.find(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "license", "bytes_saved", "similarity",
                        F.concat_ws(" ", "differences").alias("differences"))


OP10_SQL = r"""
WITH cut AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), items AS (
    SELECT item, w, least(len(w), 10) AS n FROM cut WHERE len(w) > 0
), item_windows AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), doc_windows AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT d.r, d.i, d.n, t.item FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.words = t.words
), words AS (
    SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), found AS (
    SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""


@query("op10_decontaminate", OP10_SQL)
def op10(spark, sf_dir):
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


# crc32 of a short ASCII text, as DuckDB has no such function
CRC_TABLE_SQL = """crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
)"""


def crc_sql(text: str, table: str = "t") -> str:
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1])), 4294967295)"""


_NO = "{'c': 1000000000, 'a': '', 'r': []::VARCHAR[]}"


def _edit_sql(state: str, letter: str, cost: str, added: str | None = None) -> str:
    r = f"{state}.r" if added is None else f"list_append({state}.r, {added})"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {r}}}"


def _keep_sql(state: str, initial: str) -> str:
    return f"CASE WHEN NOT forced AND initial = '{initial}' THEN {_edit_sql(state, 'K', '3 * cut', 'line')} ELSE {_NO} END"


def _rerole_sql(state: str, role: str) -> str:
    return f"CASE WHEN NOT forced THEN {_edit_sql(state, 'R', '(3 + 3 * cut)', f"'{role}:' || text")} ELSE {_NO} END"


OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL}, damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
          FROM conversations, crc_table)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), marked AS (
    SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_char,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
    FROM placed
), turns AS (
    SELECT *, is_blank OR seen AS forced, role || ':' || text AS line,
        (NOT is_blank AND NOT seen AND last_char NOT IN ('.', '!', '?'))::INTEGER AS cut
    FROM marked
), walk AS (
    SELECT conv_id, 0::BIGINT AS pos, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS s0, {_NO} AS s1,
        {{'c': 3, 'a': 'I', 'r': ['user:']}} AS s2, {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s3
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, pos, n0, n1, n2, list_min([n3, {_edit_sql('n2', 'I', '3', "'assistant:'")}]) AS n3 FROM (
      SELECT conv_id, pos, n0, n1, list_min([n2, {', '.join(_edit_sql(f'n{s}', 'I', '3', "'user:'") for s in (0, 1, 3))}]) AS n2, n3 FROM (
        SELECT w.conv_id, t.pos, {_edit_sql('s0', 'D', '4')} AS n0,
            list_min([{_edit_sql('s1', 'D', '4')}, {_keep_sql('s0', 's')}]) AS n1,
            list_min([{_edit_sql('s2', 'D', '4')}, {', '.join(f"{_keep_sql(f's{s}', 'u')}, {_rerole_sql(f's{s}', 'user')}" for s in (0, 1, 3))}]) AS n2,
            list_min([{_edit_sql('s3', 'D', '4')}, {_keep_sql('s2', 'a')}, {_rerole_sql('s2', 'assistant')}]) AS n3
        FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos + 1)))
, ends AS (
    SELECT conv_id, arg_max(list_min([s0, s3]), pos) AS e FROM walk GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(is_blank::INTEGER) AS blank,
        sum((seen AND NOT is_blank)::INTEGER) AS duplicate, sum(cut) AS truncated,
        sum((pos > 1 AND coalesce(before, '') || initial NOT IN ('su', 'ua', 'au'))::INTEGER) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.e.c::BIGINT AS cost, e.e.a AS audit,
    sha256(array_to_string(e.e.r, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op11_turn_repair", OP11_SQL)
def op11(spark, sf_dir):
    return turn_repair.repair(turn_repair.damage(read_table(spark, sf_dir, "conversations")))


OP12_SQL = f"""
WITH {CRC_TABLE_SQL}, own AS (
    SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {crc_sql("conv_id::VARCHAR")} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM own), crc_table
), rebuilt AS (
    SELECT c.conv_id, 0 AS part, i, r, x FROM convs c JOIN own o ON o.conv_id = c.base AND o.i <= c.h
    UNION ALL
    SELECT c.conv_id, 1 AS part, i, r, x FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
), paths AS (
    SELECT c.conv_id, coalesce(list(sha256(length(r) || ':' || r || x) ORDER BY part, i) FILTER (i IS NOT NULL), []) AS p,
        coalesce(list(strlen(x) ORDER BY part, i) FILTER (i IS NOT NULL), []) AS b
    FROM convs c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id
), members AS (
    SELECT conv_id, d, sha256(array_to_string(p[1:d], ',')) AS key, CASE WHEN d > 0 THEN sha256(array_to_string(p[1:d - 1], ',')) END AS parent,
        CASE WHEN d > 0 THEN b[d] ELSE 0 END AS own, d = len(p) AS last
    FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM paths)
), nodes AS (
    SELECT key, any_value(parent) AS parent, max(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, max(own) AS own,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
    FROM members GROUP BY key
), kids AS (
    SELECT parent AS key, count(*) AS kids FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), full_nodes AS (
    SELECT n.*, coalesce(kids, 0) AS kids FROM nodes n LEFT JOIN kids USING (key)
), sums AS (
    SELECT m.key, sum((n.kids = 0)::INTEGER) AS leaves, sum((n.n - 1) * n.own) AS saved
    FROM full_nodes n JOIN members m ON m.conv_id = n.conv_id AND m.d <= n.depth GROUP BY m.key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, n.kids::BIGINT AS n_children,
    s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums s USING (key) LEFT JOIN nodes up ON up.key = n.parent
"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns_of(read_table(spark, sf_dir, "conversations"))))


OP13_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, array_to_string(w[i:i + n - 1], ' ') AS s, n
    FROM (SELECT r, w, least(len(w), 4) AS n, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM cut WHERE len(w) > 0)
), sizes AS (
    SELECT r, count(*) AS size, sha256(string_agg(s || ':' || n, chr(10) ORDER BY s, n)) AS same FROM shingles GROUP BY r
), classes AS (
    SELECT same, min(r) AS r, any_value(size) AS size FROM sizes GROUP BY same
), few AS (
    SELECT s.* FROM shingles s JOIN classes USING (r)
), links AS (
    SELECT a.r AS a, b.r AS b FROM few a JOIN few b ON a.s = b.s AND a.n = b.n AND a.r < b.r
        JOIN classes x ON x.r = a.r JOIN classes y ON y.r = b.r AND 100 * least(x.size, y.size) >= 80 * greatest(x.size, y.size)
    GROUP BY a.r, b.r HAVING 100 * count(*) >= 80 * (any_value(x.size) + any_value(y.size) - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT r AS a, r AS b FROM classes
    UNION
    SELECT reach.a, e.b FROM reach JOIN both_ways e ON e.a = reach.b
), component AS (
    SELECT a, min(b) AS c FROM reach GROUP BY a
), of_row AS (
    SELECT z.r, z.size, m.c FROM sizes z JOIN classes k USING (same) JOIN component m ON m.a = k.r
), low AS (
    SELECT c, min(doc_id) AS component_id FROM of_row JOIN cut USING (r) GROUP BY c
)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, CASE WHEN size IS NULL THEN doc_id ELSE component_id END AS component_id,
    coalesce(doc_id = CASE WHEN size IS NULL THEN doc_id ELSE component_id END, false) AS kept
FROM cut LEFT JOIN of_row USING (r) LEFT JOIN low USING (c)
"""


@query("op13_hyperminhash", OP13_SQL)
def op13(spark, sf_dir):
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")
