import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np

import brute
import data
from sheetrecon.llm import importance


def item_words(text):
    return brute.ITEM_WORD.findall((text or "").translate(brute.LOWER))


def features(text):
    w = item_words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def expected(rows, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in rows for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
            for b in range(10000)]
    out = []
    for i, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score, len(item_words(text))))
    enough = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = 5 * len(enough) // 100
    rows = [(*r[:4], j + 1 if j < k else None) for j, r in enumerate(enough)]
    return Counter(rows + [(*r[:4], None) for r in out if r[4] < 20])


def test_crc_of_joined_words():
    r = random.Random(1)
    words = [bytes(r.choices(range(97, 123), k=r.choice([1, 2, 5, 40, 64, 65, 127, 128, 500, 9000]))) for _ in range(60)]
    for k, run in enumerate(importance.Joined()(words)):
        assert run.tolist() == [zlib.crc32(b" ".join(words[i:i + k + 1])) for i in range(len(words) - k)]
    assert [len(x) for x in importance.Joined()([])] == [0, 0, 0]


def test_scores_and_ranks_follow_the_definition(spark):
    rows, docs = data.corpus(spark, 150)
    target = spark.read.parquet(f"{data.SF}/benchmark.parquet")
    got = Counter(tuple(r) for r in importance.resampled(docs, target).collect())
    assert got == expected(rows, [r.text for r in target.collect()])


def test_small_tables_and_long_texts(spark):
    none = data.documents(spark, [])
    assert importance.resampled(none, none).count() == 0
    rows = [(i % 3, "w " * 700_000) for i in range(4)] + [(None, "many words of this " * 9)] * 20
    docs = data.documents(spark, rows)
    assert Counter(tuple(r) for r in importance.resampled(docs, none).collect()) == expected(rows, [])


def test_radix_sort_places(spark, monkeypatch):
    monkeypatch.setattr(importance, "PART_MOST", 64)
    monkeypatch.setattr(importance, "PART_LEAST", 16)
    r = random.Random(4)
    rows = [(r.choice([-5, 0, 1 << 40, None, r.getrandbits(20)]), r.choice([None, 1, 2, -(1 << 63), (1 << 63) - 1]), i)
            for i in range(900)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5)
    for down in (True, False):
        got = importance.radix_sorted(df, [("a", down), ("b", False), ("i", True)], 5).orderBy("place").collect()
        assert [x.place for x in got] == list(range(len(rows)))
        key = lambda x: (x[0] is None, (-x[0] if down else x[0]) if x[0] is not None else 0,
                         x[1] is None, x[1] or 0, -x[2])
        assert [tuple(x[:3]) for x in got] == sorted(rows, key=key)


def test_radix_sort_is_stable_and_whole(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(500)], "a long, k long").coalesce(1)
    got = importance.radix_sorted(df, [("a", False)]).orderBy("place").collect()
    assert [(x.a, x.k) for x in got] == sorted([(k % 3, k) for k in range(500)])
    assert np.array_equal([x.place for x in got], np.arange(500))
