import struct
import zlib
from collections import defaultdict

import corpus_pipeline
import odd
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from tidemark.llm import base, packing
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def check(rows, texts, capacity):
    """Round trip of every document, gapless sequences; the number of sequences."""
    by, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(by) == set(texts)
    for doc, text in texts.items():
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        at = 0
        for i, r in enumerate(sorted(by[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids) and (len(ids) > capacity or len(by[doc]) == 1)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-total // capacity)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    used, bound = check(QUERIES["op7_best_fit_packing"](spark, SF).collect(), texts, 2048)
    assert used <= bound * 1.02 + 1


def test_odd_texts(spark):
    texts = [*odd.TEXTS, "<|endoftext|> a", "tab\there", "double  space", " lead", "trail ", "a\x01b", "x" * 5000, "a\r\nb", "l'été, it's 12.5%"]
    for capacity in (16, 2048):
        rows = packing.pack(odd.documents(spark, texts), PATH, capacity=capacity).collect()
        check(rows, dict(enumerate(texts)), capacity)
    assert packing.pack(odd.empty(spark), PATH).count() == 0


def test_repeated_rows(spark):
    df = odd.documents(spark, ["a b c"] * 30)
    rows = packing.pack(df.unionByName(df), PATH).collect()
    assert len(rows) == 60 and len({(r.sequence_id, r.offset) for r in rows}) == 60 and len({r.sequence_id for r in rows}) == 1


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_encoder_equals_tokenizer(text):
    got = packing.Encoder.__new__(packing.Encoder)
    got.__dict__ = ENCODER.__dict__
    assert got.ids(text) == struct.pack(f"<{len(i := TOKENIZER.encode(text, add_special_tokens=False).ids)}I", *i)


ENCODER = packing.Encoder(PATH)


def spread(bins):
    out = defaultdict(int)
    for b in bins:
        for s, k in b.parts:
            out[s] += k * b.count
    return dict(out)


def best(counts, capacity):
    """Fewest sequences, by trying everything."""
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    found = [len(items)]

    def go(i, free):
        if len(free) >= found[0]:
            return
        if i == len(items):
            found[0] = len(free)
            return
        for room in {f for f in free if f >= items[i]}:
            j = free.index(room)
            go(i + 1, free[:j] + [room - items[i]] + free[j + 1 :])
        go(i + 1, [*free, capacity - items[i]])

    go(0, [])
    return found[0]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 10), st.integers(1, 2), max_size=4))
def test_reduction_loses_nothing(counts):
    """Fixed sequences belong to a best packing: the best for the rest adds up to the best."""
    fixed, left = packing.reduce_dominated(counts, 10)
    assert all(sum(s * k for s, k in b.parts) + b.free == 10 and b.free >= 0 for b in fixed)
    both = spread(fixed)
    for s, n in left.items():
        both[s] = both.get(s, 0) + n
    assert both == counts
    assert sum(b.count for b in fixed) + best(left, 10) == best(counts, 10)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=20))
def test_best_fit_places_all(counts):
    bins = packing.best_fit(counts, 50)
    assert spread(bins) == counts and all(b.free == 50 - sum(s * k for s, k in b.parts) >= 0 for b in bins)
    least = max(-(-sum(s * n for s, n in counts.items()) // 50), sum(n for s, n in counts.items() if s > 25))
    assert sum(b.count for b in bins) <= 2 * least


def test_added_tokens_as_the_tokenizer_gives_them(spark, tmp_path):
    """The query and the pipeline, against the tokenizer as loaded."""
    loaded = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|> a", "a b<|endoftext|>  <|endoftext|>\n", "<|endoftext", "plain words"]
    odd.documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, t in enumerate(texts):
        ids = loaded.encode(t, add_special_tokens=False).ids + [0]
        want[i] = (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
    for out in (QUERIES["op7_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in out.collect()} == want


def test_workers_get_few_bytes_at_once(spark, monkeypatch):
    """Of 9,000 texts of 2 KB a worker holds a few megabytes; the session's setting comes back."""
    got = []

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes], "rows": [batch.num_rows]})

    def spy(df, purpose):
        texts = df.sparkSession.range(0, 9000, 1, 1).select(F.expr("repeat('x', 2000)").alias("text"))
        got.append(texts.mapInArrow(sizes, "bytes long, rows long").collect())
        return base.stored(df, purpose)

    monkeypatch.setattr(packing, "stored", spy)
    before = spark.conf.get(base._BATCH)
    rows = packing.pack(odd.documents(spark, ["a b", None]), PATH).collect()
    assert len(rows) == 2 and spark.conf.get(base._BATCH) == before
    assert sum(r.rows for r in got[0]) == 9000 and max(r.bytes for r in got[0]) <= 1.1 * base.BATCH_BYTES


def test_batches_of_a_session_come_back(spark):
    spark.conf.set(base._BATCH, "7m")
    try:
        with pytest.raises(ValueError), base.small_batches(spark):
            assert spark.conf.get(base._BATCH) == str(base.BATCH_BYTES)
            raise ValueError
        assert spark.conf.get(base._BATCH) == "7m"
    finally:
        spark.conf.unset(base._BATCH)


def test_tokenizer_is_loaded_when_needed():
    encoder = packing.Encoder(PATH, special_as_text=False)
    encoder.ids("plain words")
    assert encoder.loaded is None
    assert struct.unpack("<I", encoder.ids("<|endoftext|>")) == (50256,)
