"""Registered queries: names and row counts of all, those that SQL can express
against their SQL, ids of the packing and wavelet queries against the tokenizers
library; the pipeline stage by stage. (Brute force over small tables with nulls,
repeats and long texts is in the other modules, operator by operator.)"""

import os

import duckdb
import pytest

import corpus_pipeline
from lakeshelf.llm import queries
from lakeshelf.session import materialize, read_table
from scripts.check_oracle import TABLES, digest

COLUMNS = {
    "op1_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op2_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op3_quality_model": ["doc_id", "held_out", "score", "predicted"],
    "op4_url_trust": ["page_id", "host", "path", "rule", "verdict"],
    "op5_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_wavelet": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op8_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_licenses": ["doc_id", "start", "end", "license", "bytes_saved", "similarity", "differences"],
    "op10_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op11_turn_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13_hyperminhash": ["doc_id", "n_shingles", "component_id", "kept"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_runs(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.columns == COLUMNS[name]
    rows = df.count()
    table = "pages" if name.startswith("op4") else "documents"
    if name.startswith("op11"):
        assert rows == read_table(spark, sf, "conversations").select("conv_id").distinct().count()
    elif name[:4] not in ("op1_", "op9_", "op12"):
        assert rows == read_table(spark, sf, table).count()
    assert rows > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    rel = con.execute(queries.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, rel.fetchall())[0]


def test_token_ids_are_the_library_s(spark, sf):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer
    from lakeshelf.llm import tokens
    library = Tokenizer.from_str(tokens.load())
    docs = sorted((r.doc_id, r.text or "") for r in read_table(spark, sf, "documents").select("doc_id", "text").collect())
    ids = {d: np.array(e.ids + [2], dtype="<u4") for (d, _), e in zip(docs, library.encode_batch([t for _, t in docs], add_special_tokens=False))}
    start = dict(zip([d for d, _ in docs], np.cumsum([0] + [len(ids[d]) for d, _ in docs]).tolist()))
    assert {tuple(r) for r in queries.QUERIES["op6_wavelet"](spark, sf).collect()} == {
        (d, start[d], len(x), zlib.crc32(x.tobytes())) for d, x in ids.items()}
    held = {}
    for r in queries.QUERIES["op1_packing"](spark, sf).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        held.setdefault(r.doc_id, []).append(r.length)
    assert {d: sum(n) for d, n in held.items()} == {d: len(x) for d, x in ids.items()}


def test_pipeline(spark, sf):
    docs = read_table(spark, sf, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), "test")
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    left = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left


def test_pipeline_on_an_empty_table(spark, sf):
    docs = read_table(spark, sf, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "test")
        assert docs.count() == 0
