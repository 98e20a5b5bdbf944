from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import data
from sheetrecon.llm import suffixes, superkmers
from sheetrecon.llm.common import doc_key


def items():
    given = [(str(i), " ".join(t.split()[:n])) for i, (t, n) in enumerate(
        (t, n) for _, t in data.odd_rows() if t and len(t.split()) > 25 for n in (13, 20, 4))]
    return given + [("none", None), (None, "w1 w2"), ("empty", ""), ("dots", "... !!"), ("0", "w3 w4")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
def test_contamination(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(suffixes.benchmark_blocks, "__defaults__", (block_bytes,))
    rows, docs = data.corpus(spark)
    bench = spark.createDataFrame(items(), "item_id string, text string").withColumn("name", F.lit("clash"))
    found = suffixes.contamination(docs, bench).collect()
    got = Counter(tuple(r[:6]) for r in found)
    want = brute.contamination(rows, items())
    assert got == want
    assert Counter((r[0], *r[6:]) for r in found) == brute.longest(rows, items())
    assert max(r.longest_words for r in found) > suffixes.WINDOW
    kept = suffixes.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k in want.elements() if not k[5])


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"t{i}" for i in range(30)) + " c")], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "x y " + " ".join(f"T{i}" for i in range(5, 25)) + " z")],
                                  "item_id string, text string")
    assert [tuple(r) for r in suffixes.longest_matches(docs, bench).collect()] == [("q", 1, 20, 2, 7)]


def test_matches_end_where_they_end(spark):
    say = lambda a, b: " ".join(f"t{i}" for i in range(a, b))
    docs = spark.createDataFrame([(1, "x " + say(0, 500) + " y"), (2, say(100, 120) + " z " + say(100, 120)),
                                  (3, say(480, 499)), (4, "rep " * 40), (5, "s1"), (6, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("q", say(0, 500)), ("r", "rep " * 20), ("s", "s1"), ("t", say(100, 120))],
                                  "item_id string, text string")
    got = {r.doc_id: tuple(r[6:]) for r in suffixes.contamination(docs, bench).collect()}
    assert got == {1: (500, "q", 1, 0), 2: (20, "q", 0, 100), 3: (19, "q", 0, 480), 4: (20, "r", 0, 0),
                   5: (1, "s", 0, 0), 6: (0, None, None, None)}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id string, text string")
    rows, docs = data.corpus(spark, 5)
    assert {r.n_hit for r in suffixes.contamination(docs, bench).collect()} == {0}
    none = data.documents(spark, [])
    assert suffixes.contamination(none, bench).count() == 0 == superkmers.dedup_substrings(none).count()


def test_suffix_array_order():
    r = np.random.default_rng(0)
    ids = r.integers(0, 3, 200)
    order, rank = suffixes.suffix_array(ids, 13)
    cut = [tuple(ids[i:i + 13].tolist()) for i in order]
    assert cut == sorted(cut)


def substring_order(spark, docs):
    """Position of each row by the documented order: null ids first, then id, then key."""
    rows = docs.select("doc_id", "text", doc_key("doc_id", "text").alias("k")).collect()
    keys = sorted({(r.doc_id is not None, r.doc_id or 0, r.k) for r in rows})
    place = {k: n for n, k in enumerate(keys)}
    return [(r.doc_id, r.text) for r in rows], [place[r.doc_id is not None, r.doc_id or 0, r.k] for r in rows]


@pytest.mark.parametrize("chunk", [8 << 20, 3000])
def test_repeated_windows(spark, monkeypatch, chunk):
    monkeypatch.setattr(superkmers, "CHUNK_BYTES", chunk)
    _, docs = data.corpus(spark)
    rows, order = substring_order(spark, docs)
    got = Counter(tuple(r) for r in superkmers.dedup_substrings(docs).collect())
    assert got == brute.substrings(rows, order)


def test_minimisers_of_windows():
    values = np.random.default_rng(3).integers(0, 1 << 63, 100, dtype=np.uint64)
    plain = np.zeros(1 << superkmers.SLOT_BITS, bool)
    mixed = superkmers.sequences(values, superkmers.MINIMISER, superkmers.ODD) * superkmers.ODD[9] >> np.uint64(1)
    span = superkmers.WINDOW - superkmers.MINIMISER + 1
    least = [mixed[i:i + span].min() for i in range(100 - superkmers.WINDOW + 1)]
    assert superkmers.minimisers(values, plain).tolist() == least
    assert len(superkmers.minimisers(values[:5], plain)) == 0
    for length in (1, 2, 3, 20):
        h = superkmers.windows_hash(values, length, 12345)
        assert len(h) == 101 - length
        assert (superkmers.windows_hash(values[7:60], length, 12345) == h[7:61 - length]).all()
