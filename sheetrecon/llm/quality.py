"""Quality rules with n-gram perplexity (operator 6).

Base rules count words, symbols, repeated lines and repeated eight-word
windows. A byte 5-gram modified Kneser-Ney model for each language, counted by
Spark over all documents, gives each text a perplexity per character; texts outside
their language's band are rejected. The log perplexity of a text is a mean over its
characters, so it strays from the language's median by the inverse root of their
number: the band is set on the deviation times that root (quartiles of the texts that
pass the base rules, plus or minus a multiple of the interquartile range), and is
narrower for longer texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kneser_ney
from .common import Bits, batched, release, settled, text_bytes, words

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: Interquartile ranges below and above the quartiles that a text may lie.
BELOW, ABOVE = 2.5, 2.5
FACTORS = np.random.default_rng(8).integers(1, 1 << 62, WINDOW, dtype=np.int64) * 2 + 1


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in some ``window``-word sequence found twice or more."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    value = np.array([hash(t) for t in tokens], np.int64)
    with np.errstate(over="ignore"):
        key = value[:n] * FACTORS[0]
        for i in range(1, window):
            key += value[i:i + n] * FACTORS[i]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    step = np.zeros(len(tokens) + 1, np.int64)
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    step[starts] += 1
    step[starts + window] -= 1
    return int((np.cumsum(step) > 0).sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    tokens = words(text)
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip():
            seen.add(line)
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    return len(tokens), len(b"".join(tokens).decode()), symbols, again, repeated_words(tokens)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in NAMES]))
def measured(text: pa.Array) -> pa.Array:
    rows = [measures(t) for part in text_bytes(text) for t in part]
    columns = np.array(rows, np.int64).reshape(-1, len(NAMES))
    release()
    return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(len(NAMES))], NAMES)


def base_failed() -> Column:
    return (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words")
                                               > MAX_REPEAT_PERCENT * F.col("m.n_words"))


def scored(docs: DataFrame, keep: dict[str, Column], text_col: str, lang_col: str) -> DataFrame:
    """Columns ``keep`` of every row, with grp (its language), m (the base measures),
    base_failed, perplexity."""
    model = kneser_ney.train(kneser_ney.counted_grams(batched(docs), lang_col, text_col))
    values = model.probs[-1].select("grp", "gram", F.log10("p").alias("lp"))
    lang, text = F.col("grp"), F.col("text")
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(lang_col).cast("string").alias("grp"),
                       F.col(text_col).alias("text"))
    rows = kneser_ney.with_scores(rows, values, lang, text).withColumn("m", measured(text)).drop("text")
    # the model predicts the words, a blank between two, and the end
    return (rows.withColumn("base_failed", base_failed())
            .withColumn("perplexity", F.when(F.col("m.n_words") > 0, F.pow(
                F.lit(10.0), -F.col("lp") / (F.col("m.word_chars") + F.col("m.n_words"))))))


def judged(docs: DataFrame, keep: dict[str, Column], text_col: str = "text", lang_col: str = "lang",
           below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """Columns ``keep`` of every row, with m (the base measures), base_failed,
    perplexity (per character; null without words), low and high (the band for a text
    of this length), kept.

    Null text: no words, hence base_failed. A null language is a language of its
    own. A language all of whose texts fail has no band, and rejects nothing more.
    """
    rows = settled("judged", scored, docs, keep, text_col, lang_col)
    passed, log = ~F.col("base_failed"), F.log10("perplexity")
    middle = kneser_ney.bounded(rows.where(passed).groupBy("grp").agg(F.percentile_approx(log, 0.5, 10_000).alias("middle")))
    root = F.sqrt(F.when(F.col("m.n_words") > 0, F.col("m.word_chars") + F.col("m.n_words")))
    rows = kneser_ney.joined(rows, middle, [], "left")
    bands = kneser_ney.bounded(
        rows.where(passed).groupBy("grp")
        .agg(F.percentile_approx((log - F.col("middle")) * root, [0.25, 0.75], 10_000).alias("q"))
        .select("grp", F.expr(f"q[0] - {below} * (q[1] - q[0])").alias("least"),
                F.expr(f"q[1] + {above} * (q[1] - q[0])").alias("most")))
    inside = F.col("low").isNull() | F.col("perplexity").between(F.col("low"), F.col("high"))
    edges = {name: F.pow(F.lit(10.0), F.col("middle") + F.col(edge) / root)
             for name, edge in (("low", "least"), ("high", "most"))}
    return (kneser_ney.joined(rows, bands, [], "left").withColumns(edges)
            .withColumn("kept", passed & inside).drop("grp", "lp", "middle", "least", "most"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, the five base measures, base_failed, kept, perplexity,
    low, high. Repeated rows are judged alike; other columns are ignored; an
    empty table gives an empty result."""
    rows = judged(docs, {"doc_id": F.col(id_col)}, text_col, lang_col)
    return rows.select("doc_id", *[f"m.{c}" for c in NAMES], "base_failed", "kept", "perplexity", "low", "high")


def rejected_keys(docs: DataFrame, keys: dict[str, Column], text_col: str, lang_col: str) -> DataFrame:
    """The ``keys`` of the rows of ``docs`` that the rules reject."""
    rows = judged(docs, keys, text_col, lang_col)
    return rows.where(~F.coalesce("kept", F.lit(False))).select(*keys).distinct()


def drop_rejected(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged. The verdict follows from language
    and text, and goes by two hashes of both: no copy of the rows is written."""
    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`")
    # a null adds nothing to a hash: the number between the two tells which of them is missing
    keys = {"key": F.xxhash64(lang, F.lit(0), text), "other": F.xxhash64(F.lit(1), text, F.lit(0), lang)}
    gone = settled("rejected", rejected_keys, docs, keys, text_col, lang_col)
    rows = docs.select(*[c.alias(n) for n, c in keys.items()], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # rows that the bit table excludes are kept and need not be shuffled
    rows = rows.withColumn("some", Bits(gone, "key").column("key"))
    kept = rows.where("some").join(gone, list(keys), "left_anti")
    return kept.unionByName(rows.where("not some")).select("row.*")
