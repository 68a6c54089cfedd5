"""The registered queries on the driver's smallest tables, against SQL or plain versions."""

import os

import brute
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__

    return __spark_entry__


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_url_filters", "op11_phrases", "op13_warc"])
def test_oracle(spark, entry, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    tidy = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert tidy(got) == tidy(want)


def test_op2(spark, entry, texts):
    got = {r.doc_id: r for r in entry.queries()["op2_simhash"](spark, SF).collect()}
    fps = [(d, brute.fingerprint(t)) for d, t in texts]
    want = brute.components(fps)
    assert all(got[d].fingerprint == f"{f:016x}" and got[d].component_id == want[d] for d, f in fps) and len(got) == len(texts)


def test_op4(spark, entry, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(map(tuple, entry.queries()["op4_decontamination"](spark, SF).drop("spans", "items").collect()))
    assert got == sorted(brute.contamination(texts, items))


def test_op5_held_out_accuracy(spark, entry):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in entry.queries()["op5_language"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op6(spark, entry, texts):
    got = sorted(map(tuple, entry.queries()["op6_suffix_array"](spark, SF).collect()))
    assert got == sorted(brute.repeats([(d, (t or "").encode()) for d, t in texts]))


def test_op9_beats_its_base_on_held_out_texts(spark, entry):
    held = [r for r in entry.queries()["op9_lm_scoring"](spark, SF).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_pipeline_is_its_stages(spark, entry, texts):
    import corpus_pipeline
    from test_llm_operators import check_pieces
    from test_whole_job import jaccard_keeps

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        assert now.columns == docs.columns
        seen.append({r.doc_id: r.text for r in now.collect()})
    dropped = {d: t for d, t in seen[0].items() if d not in seen[2]}
    assert set(seen[0]) == {d for d, t in texts if t} and set(seen[2]) == jaccard_keeps(seen[1]) and len(dropped) > 0
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute.contamination(list(seen[2].items()), items) if not r[5]}
    assert set(seen[3]) == clean
    check_pieces(entry.queries()["pipeline"](spark, SF).collect(), seen[3].items(), 2048)


def test_op1(spark, entry, texts):
    import hashlib
    import zlib

    got = {r.doc_id: r for r in entry.queries()["op1_media_columns"](spark, SF).collect()}
    assert len(got) == len(texts)
    for d, t in texts:
        own = (t or "").encode()
        data = own + b"\xff" * (-len(own) % 576 if own else 576)
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(own), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), None) and r.media_bytes > len(data)


def test_op3(spark, entry, texts):
    from test_llm_operators import check_pieces

    check_pieces(entry.queries()["op3_packing"](spark, SF).collect(), texts, 2048)


def test_op9_base(spark, entry, texts):
    import math
    import re
    import zlib
    from collections import Counter

    tokens = {d: [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for d, t in texts}
    count = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    rows = entry.queries()["op9_lm_scoring"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r.doc_id]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1, len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
