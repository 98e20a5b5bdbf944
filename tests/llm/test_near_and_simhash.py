import random
from collections import Counter

import numpy as np

import brute
import data
from sheetrecon.llm import near, simhash


def test_bit_sliced_distances():
    r = np.random.default_rng(1)
    for m in (1, 2, 63, 64, 65, 200):
        fp = r.integers(0, 1 << 63, m, dtype=np.uint64)
        fp[m // 2:] = fp[0] ^ (np.uint64(1) << r.integers(0, 60, m - m // 2).astype(np.uint64))
        true = np.bitwise_count(fp[:, None] ^ fp[None, :])
        for radius in range(8):
            assert (near.bit_sliced(fp, radius) == (true <= radius)).all()


def test_block_masks_keep_every_pair_within_the_radius():
    r = random.Random(2)
    masks = near.block_masks(3, 2)
    for _ in range(2000):
        flip = sum(1 << b for b in r.sample(range(64), r.randint(0, 3)))
        assert any(flip & m == 0 for m in masks)


def test_hot_cells_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(near, "CELL", 8)
    monkeypatch.setattr(near, "SAMPLE", 1)
    r = random.Random(3)
    base = [r.getrandbits(40) for _ in range(15)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), 1)) for b in base for _ in range(12)} | set(base))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute.connected(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 2)
    for sliced in (True, False):
        roots = {x.node: x.root for x in near.components(near.fingerprint_links(df, 2, sliced=sliced)).collect()}
        got = [roots.get(f, f) for f in signed]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_paths_and_cliques(spark):
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + j) for i in range(8) for j in range(i)] + [(5, 5)]
    got = {r.node: r.root for r in near.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(8)}}
    assert near.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_follow_the_definition(spark):
    rows, docs = data.corpus(spark)
    got = Counter(tuple(r) for r in simhash.simhash_groups(docs).collect())
    assert got == brute.simhash_rows(rows)


def test_one_document_of_each_group_stays(spark):
    rows, docs = data.corpus(spark, 60)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    fp = [brute.simhash(t) for _, t in rows]
    group = brute.connected(len(rows), lambda i, j: bin(fp[i] ^ fp[j]).count("1") <= 2)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(None if n else i for n, i in least.values())


def test_empty_table(spark):
    none = data.documents(spark, [])
    assert simhash.simhash_groups(none).count() == 0
    assert simhash.keep_one_per_group(none).columns == none.columns
