"""Documents with every odd case that the operators define a result for."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside: none may clash.
CLASHES = ["fp", "key", "cell", "root", "row", "m", "lp", "bucket", "grp", "place", "gone", "left", "some", "tie",
           "part", "ids", "kept", "block", "train", "text_hash", "component_id", "n_words", "line", "word", "gram"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: " ".join(r.choices(vocabulary, k=n))
    shared, line = say(60), "A shared line, of more than five words; it comes back."
    long = "\n".join(say(50) for _ in range(120))
    rows = [
        (None, None), (None, ""), (None, say(30)), (None, "one two three"), (7, None), (7, ""), (8, " \t\n\r "),
        (9, say(40)), (9, say(40)), (10, "x"), (11, "a b"), (12, long), (13, long), (14, long.replace("w7 ", "w8 ")),
        (15, shared + " " + say(30)), (16, say(25) + "\n" + shared), (17, f"{line}\n{say(20)}\n{line}"),
        (18, f"{say(20)}\n{line.upper()}\n{say(3)}"), (19, line.replace("comes", "came")), (20, "rep " * 400),
        (21, "日本語 テキスト x   é É ß " + say(20)), (22, "<|endoftext|> 's don't 12 345 !!! " + say(20)),
        (23, "# * $ % & | < > " * 10), (24, shared), (25, shared), (26, say(13)),
    ]
    rows += [rows[7], rows[7], rows[0], rows[11]]
    return rows


def documents(spark, rows=None, clashing=True):
    rows = odd_rows() if rows is None else rows
    langs = [None, "en", "fr", "en"]
    full = [(i, t, langs[k % 4], "s", len(t or "")) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    if clashing:
        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def corpus(spark, n=120):
    """Some given documents and the odd ones: (rows, DataFrame)."""
    given = [(r.doc_id + 1000, r.text) for r in
             spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]
    rows = odd_rows() + given
    return rows, documents(spark, rows).repartition(3)
