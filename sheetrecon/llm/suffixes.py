"""Benchmark decontamination with suffix arrays over the training text
(operator 7).

Each step of a task turns its documents into one shard: the word sequence of
all its texts (documents apart) with its suffix array. Every suffix of every
benchmark item is looked up in the shard by binary search, which gives the
places of the matches of a whole window, and so the words of each document that
a benchmark window covers. Windows that match one after the other, in the item as
in the document, are one longer match: its length and place follow without a
limit. The benchmark is taken in blocks of bounded size, a broadcast and a narrow
pass each, with a written table between; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, materialize, release, text_bytes

WINDOW = 13
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 8 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Every byte outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` becomes a blank.
WORDS_ONLY = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in LOWER)


def item_words(text: bytes) -> list[bytes]:
    return text.translate(WORDS_ONLY).split()


def suffix_array(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank): suffixes of ``ids`` sorted by their first ``depth``
    ids at least, by prefix doubling; ties keep one rank."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank)
    size, n = 1, len(ids)
    while size < depth:
        after = np.zeros(n, np.int64)
        after[:n - size] = rank[size:] + 1
        key = rank * np.int64(n + 1) + after
        order = np.argsort(key)
        step = np.concatenate([[0], key[order][1:] != key[order][:-1]]).astype(np.int64) if n else rank
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        size *= 2
    return order, rank


@dataclass
class Block:
    """A block of benchmark items: the words of all items (one number each from
    ``vocabulary``), where each suffix starts and how many of its words count."""

    items: list[str]
    vocabulary: dict[bytes, int]
    ids: np.ndarray
    starts: np.ndarray
    spans: np.ndarray
    owner: np.ndarray
    #: Where each item's words start, and its place among the names in order.
    first: np.ndarray
    rank: np.ndarray


def block_of(rows: list, window: int = WINDOW) -> Block:
    """Items (name, text) -> block. A window is ``window`` words, or the whole of
    a shorter item; items without words have none."""
    names, vocabulary, ids, starts, spans, owner, first = [], {}, [], [], [], [], []
    for name, text in rows:
        tokens = item_words((text or "").encode())
        if tokens:
            span = min(window, len(tokens))
            for i in range(len(tokens) - span + 1):
                starts.append(len(ids) + i)
                spans.append(span)
                owner.append(len(names))
            first.append(len(ids))
            ids += [vocabulary.setdefault(w, len(vocabulary)) for w in tokens]
            names.append(name)
    to_array = lambda x: np.array(x, np.int64)
    order = {name: i for i, name in enumerate(sorted(set(names)))}
    return Block(names, vocabulary, to_array(ids), to_array(starts), to_array(spans), to_array(owner),
                 to_array(first), to_array([order[n] for n in names]))


def narrowed(text: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, at: int,
             wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of many ranges at once: within each range of the suffix
    array (suffixes that agree on ``at`` ids) those whose next id is wanted."""
    def bound(right: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while (live := a < b).any():
            mid = (a + b) >> 1
            place = order[np.minimum(mid, len(order) - 1)] + at
            seen = np.where(place < len(text), text[np.minimum(place, len(text) - 1)], np.iinfo(np.int64).min)
            less = live & ((seen <= wanted) if right else (seen < wanted))
            a, b = np.where(less, mid + 1, a), np.where(live & ~less, mid, b)
        return a

    return bound(False), bound(True)


def shard_matches(texts: list[bytes], block: Block, window: int = WINDOW):
    """One shard of whole texts against a block.

    Returns the word counts, and for each match of a whole window the position in
    the shard's word sequence and the number of the benchmark suffix.
    """
    unknown = len(block.vocabulary)
    find = block.vocabulary.get
    tokens = [item_words(t) for t in texts]
    counts = np.array([len(w) for w in tokens], np.int64)
    # words that no item holds match nothing: one number; documents end with another
    text = np.array([n for w in tokens for n in [*(find(x, unknown) for x in w), unknown + 1]], np.int64)
    order, _ = suffix_array(text, window)
    low = np.zeros(len(block.starts), np.int64)
    high = np.full(len(block.starts), len(order), np.int64)
    longest = np.zeros(len(block.starts), np.int64)
    for at in range(window):
        live = np.flatnonzero((high > low) & (block.spans > at))
        if not len(live):
            break
        a, b = narrowed(text, order, low[live], high[live], at, block.ids[block.starts[live] + at])
        low[live], high[live] = a, b
        longest[live[b > a]] = at + 1
    whole = np.flatnonzero((longest == block.spans) & (high > low))
    sizes = high[whole] - low[whole]
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = order[np.repeat(low[whole], sizes) + inside]
    return counts, places, np.repeat(whole, sizes)


def match_runs(places: np.ndarray, suffixes: np.ndarray, block: Block) -> np.ndarray:
    """Longest extents of matches, a column each: where it starts in the shard and in
    the block's words, how many words it has, and the item's number. Windows that start
    one word later each on both sides are one match; no document or item is left, as no
    window reaches beyond either."""
    starts, owner = block.starts[suffixes], block.owner[suffixes]
    order = np.lexsort((places, places - starts, owner))
    places, starts, owner, spans = places[order], starts[order], owner[order], block.spans[suffixes][order]
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (np.diff(starts) != 1) | (np.diff(owner) != 0)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(places)))
    return np.stack([places[head], starts[head], spans[head] + size - 1, owner[head]])


def best_runs(counts: np.ndarray, runs: np.ndarray, block: Block, by_item: bool = False) -> dict:
    """Document number (with ``by_item``: and item number) -> its longest match (words,
    item, first word in the document, in the item); of equals the smallest item, then
    the earliest in the document, then in the item."""
    ends = np.cumsum(counts + 1)
    place, start, words, owner = runs
    doc = np.searchsorted(ends, place, "right")
    order = np.lexsort((start, place, block.rank[owner], -words, *([owner] if by_item else []), doc))
    key = np.stack([doc[order], owner[order] if by_item else np.zeros(len(order), np.int64)])
    first = order[np.concatenate([[True], (np.diff(key) != 0).any(0)])] if len(order) else order
    out = {}
    for d, p, s, n, o in zip(doc[first].tolist(), *runs[:, first].tolist()):
        found = (n, block.items[o], p - int(ends[d] - counts[d] - 1), s - int(block.first[o]))
        out[(d, o) if by_item else d] = found
    return out


def contaminate(texts: list[bytes], block: Block, window: int = WINDOW) -> tuple[list, list, list]:
    """Per text: the hit words as ranges [start, end), the items found, and the longest
    match (see ``best_runs``; None without one)."""
    counts, places, suffixes = shard_matches(texts, block, window)
    spans, owners = block.spans[suffixes], block.owner[suffixes]
    ends = np.cumsum(counts + 1)
    cover = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + spans, -1)
    hit = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
    ranges: list = [[] for _ in texts]
    items: list = [[] for _ in texts]
    doc = np.searchsorted(ends, edges[:, 0], "right")
    for d, (a, b) in zip(doc.tolist(), edges.tolist()):
        begin = int(ends[d] - counts[d] - 1)
        ranges[d] += [a - begin, b - begin]
    doc = np.searchsorted(ends, places, "right")
    for d, i in sorted(set(zip(doc.tolist(), owners.tolist()))):
        items[d].append(block.items[i])
    best = best_runs(counts, match_runs(places, suffixes, block), block)
    return ranges, items, [best.get(d) for d in range(len(texts))]


LONGS, STRINGS = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
MATCH = T.StructType([T.StructField("longest_words", T.LongType()), T.StructField("longest_item", T.StringType()),
                      T.StructField("longest_word", T.LongType()), T.StructField("longest_item_word", T.LongType())])
FOUND = T.StructType([T.StructField("ranges", LONGS), T.StructField("items", STRINGS), *MATCH])
MERGED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                       T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()), *MATCH])
KINDS = {T.LongType(): pa.int64(), T.StringType(): pa.string(), LONGS: pa.list_(pa.int64()),
         STRINGS: pa.list_(pa.string())}
#: No match: no words, and no place.
NONE = (0, None, None, None)


def merge(flat: list[int], names: list[str]) -> tuple[int, int, str]:
    """Union of hit ranges and of items: n_hit, n_items, items_sha256."""
    total, reach = 0, 0
    for a, b in sorted(zip(flat[::2], flat[1::2])):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    names = sorted(set(names))
    return total, len(names), hashlib.sha256(",".join(names).encode()).hexdigest()


def longer(a: tuple, b: tuple) -> tuple:
    """The longer of two matches; of equals the smaller by item and place."""
    return a if not b[0] or (a[0] and (-a[0], *a[1:]) <= (-b[0], *b[1:])) else b


def found_udf(block, window: int, last: bool):
    """Column function: text, and what earlier blocks found (FOUND) -> the same with
    this block, or for the last block n_words, what ``merge`` gives and the longest match."""
    kind = MERGED if last else FOUND

    @F.arrow_udf(kind)
    def run(text: pa.Array, found: pa.Array) -> pa.Array:
        before, out = found.to_pylist(), []
        for texts in text_bytes(text):
            for t, r, i, best in zip(texts, *contaminate(texts, block.value, window)):
                old = before[len(out)]
                r, i = old["ranges"] + r, old["items"] + i
                best = longer(tuple(old[c] for c in MATCH.names), best or NONE)
                out.append((len(item_words(t)), *merge(r, i), *best) if last else (r, i, *best))
        release()
        return pa.StructArray.from_arrays([pa.array([x[k] for x in out], KINDS[f.dataType])
                                           for k, f in enumerate(kind)], kind.names)

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int,
                     block_bytes: int = BLOCK_BYTES):
    """Yields (broadcast block, is it the last?): about ``block_bytes`` of benchmark text
    each, made one after the other; a block is the only part of the benchmark that the
    driver holds, and it is given up when the next one is asked for."""
    items = materialize(benchmark.select(F.col(item_col).cast("string").alias("name"),
                                         F.col(text_col).alias("text")), "benchmark")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i).where("name is not null")
        block = block_of([(r.name, r.text) for r in part.select("name", "text").toLocalIterator()], window)
        sent = benchmark.sparkSession.sparkContext.broadcast(block)
        yield sent, i + 1 == n
        if i + 1 < n:
            sent.unpersist()


def judged(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """row (the columns of docs), n_words, n_hit, n_items, items_sha256, MATCH, contaminated."""
    text = F.col(f"row.`{text_col}`")
    rows = batched(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = F.struct(F.array().cast(LONGS).alias("ranges"), F.array().cast(STRINGS).alias("items"),
                     *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(NONE, MATCH)])
    for block, last in benchmark_blocks(benchmark, item_col, item_text_col, window):
        rows = rows.withColumn("found", found_udf(block, window, last)(text, found))
        if not last:  # a task holds one block
            rows = materialize(rows, "found")
        found = F.col("found")
    rows = rows.select("row", "found.*")
    return rows.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the
    longest verbatim match of a window or more with an item: longest_words (0: none),
    longest_item, longest_word and longest_item_word (where it starts in the document and
    in the item, from 0); of equals the smallest item, then the earliest place.

    Null and empty texts have no words; items with a null id or text are no
    items; items that repeat an id count as one item with the windows of both, and
    matches do not go on from one to the other. Repeated rows are judged alike; a null
    doc_id is returned; other columns are ignored. Without items nothing is hit; an
    empty table gives an empty result.
    """
    return judged(docs, benchmark, text_col).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        *MATCH.names)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    return judged(docs, benchmark, text_col).where("not contaminated").select("row.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per benchmark item and document that share at least one window: item_id, doc_id,
    n_words (longest verbatim match, however long), item_word and doc_word (where it starts)."""
    kind = docs.schema[id_col].dataType.simpleString()
    plain = batched(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run_for(block):
        def run(batches):
            for batch in batches:
                at = 0
                for texts in text_bytes(batch.column(1)):
                    yield located(batch.column(0).slice(at, len(texts)), texts, block.value)
                    at += len(texts)

        return run

    schema = f"item_id string, doc_id {kind}, n_words long, item_word long, doc_word long"
    out = None
    for block, _ in benchmark_blocks(benchmark, "item_id", "text", WINDOW):
        part = materialize(plain.mapInArrow(run_for(block), schema), "matches")
        out = part if out is None else out.unionByName(part)
    return out


def located(ids: pa.Array, texts: list[bytes], block: Block) -> pa.RecordBatch:
    counts, places, suffixes = shard_matches(texts, block)
    best = best_runs(counts, match_runs(places, suffixes, block), block, by_item=True)
    found = list(best.values())
    numbers = {c: pa.array([f[k] for f in found], pa.int64())
               for c, k in (("n_words", 0), ("item_word", 3), ("doc_word", 2))}
    return pa.record_batch({"item_id": pa.array([f[1] for f in found], pa.string()),
                            "doc_id": ids.take(pa.array([d for d, _ in best], pa.int64())), **numbers})
