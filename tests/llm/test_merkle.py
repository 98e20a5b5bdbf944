import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import data
from sheetrecon.llm import merkle
from sheetrecon.llm.queries import tampered_text


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root of the leaves, and for each the list of (left, right) siblings."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append((run[:i % 3], run[i % 3 + 1:]))
        at = [i // 3 for i in at]
        nodes = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    """rows (doc_id, source, lang, n_chars, text) -> the rows of the contract."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in by:
        by[s].sort(key=lambda x: x[:3])
    built = {s: tree([x[2] for x in by[s]]) for s in names}
    root, tops = tree([built[s][0] for s in names])
    out = []
    for s, above in zip(names, tops):
        for (_, _, own, r), below in zip(by[s], built[s][1]):
            path = below + above
            now = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in path:
                now = sha(*left, now, *right)
            proof = sha(*(x for left, right in path for x in left + right))
            out.append((r[0], own, built[s][0], root, proof, now, now == root))
    return Counter(out)


def got(docs, levels=merkle.LEVELS):
    rows = merkle.verified(docs, tampered_text(), levels)
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in rows.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 30, 81, 82])
def test_places_follow_the_order_of_completion(n):
    log, open_nodes = [], defaultdict(list)

    def push(level, index):
        log.append((level, index))
        if level < merkle.height(n):
            open_nodes[level].append(index)
            sizes = [n]
            for _ in range(level):
                sizes.append(-(-sizes[-1] // 3))
            if len(open_nodes[level]) == 3 or index == sizes[level] - 1:
                open_nodes[level].clear()
                push(level + 1, index // 3)

    for i in range(n):
        push(0, i)
    assert log == sorted(log, key=lambda x: merkle.place(*x, n))
    assert [merkle.place(*x, n) for x in log] == list(range(len(log)))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_follows_the_definition(spark, levels):
    rows, _ = data.corpus(spark, 100)
    full = [(i, ["a", "b", None, "é", "a"][k % 5] if k % 3 else "hot", [None, "en"][k % 2], k % 7 or None, t)
            for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({c: F.lit("clash") for c in (*data.CLASHES, "tree", "leaf", "pos", "n", "at", "tie")})
    assert got(docs.repartition(3), levels) == brute(full)


def test_small_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.verified(spark.createDataFrame([], schema), tampered_text()).count() == 0
    one = [(5, None, None, None, "a\n" * 700_000)]
    assert got(spark.createDataFrame(one, schema)) == brute(one)
    same = [(1, "s", "en", 3, "x\ny")] * 40
    assert got(spark.createDataFrame(same, schema)) == brute(same)
