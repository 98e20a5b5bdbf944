from pyspark.sql import functions as F

from sheetrecon.functions import fmt
from sheetrecon.functions.columns import index_of, letter, letter_of
from sheetrecon.functions.symbols import decode_text, normalize_symbols
from sheetrecon.functions.text import clip
from sheetrecon.operators import profile as pr


def _sheet(spark):
    rows = [("f", 1, "TITULO", None, None), ("f", 2, "x", "PROPUESTA JKM", "CLIENTE"),
            ("f", 11, "1", " 642799 ", ""), ("f", 12, "2", "12345", "ANA"),
            ("f", 13, "77777", "", None), ("f", 14, "4", "642801", "x")]
    return spark.createDataFrame(rows, "file_path string, row_no long, c0 string, c1 string, c2 string")


def test_quality_and_levels(spark):
    q = pr.quality(_sheet(spark)).first()
    # empty cells: row1 2, row2 0, row11 1, row12 0, row13 2, row14 0 -> 5 of 18
    assert q.empty_cells == 5 and q.rows_seen == 6
    assert q.quality_score == round(100 - 5 * 100 / 18, 4)
    assert q.quality_level == "Buena"


def test_ragged_and_key_profile(spark):
    r = pr.ragged_check(_sheet(spark)).first()
    assert r.distinct_widths == 3 and r.ragged is False   # only 6 rows
    k = pr.key_profile(_sheet(spark)).first()
    assert (k.valid, k.empty) == (3, 1)
    assert k.sample_values == ["642799", "12345", "642801"]


def test_score_columns_and_search(spark):
    s = _sheet(spark)
    best = pr.score_key_columns(s, first_row=1).filter("is_best").first()
    assert best.col_ix == 1 and best.col_letter == "B" and best.n_keys == 3
    hits = pr.search_cells(s, text="propuesta").collect()
    assert [(h.row_no, h.col_ix) for h in hits] == [(2, 1)]
    nums = pr.search_cells(s, numeric=True).collect()
    assert sorted((h.row_no, h.col_ix) for h in nums) == [(11, 1), (12, 1), (13, 0), (14, 1)]
    byc = pr.cells_by_column(s, per_column=2).filter("col_ix = 1").collect()
    assert [(r.pos, r.more) for r in sorted(byc, key=lambda r: r.pos)] == [(1, 1), (2, 1)]


def test_find_label_column_appends_when_absent(spark):
    out = {r.label: (r.col_ix, r.appended)
           for r in pr.find_label_column(_sheet(spark), ["CLIENTE", "NADA"]).collect()}
    assert out == {"CLIENTE": (2, False), "NADA": (3, True)}


def test_letters():
    assert [letter_of(i) for i in (0, 1, 25, 26, 27, 701)] == ["A", "B", "Z", "AA", "AB", "ZZ"]
    assert [index_of(x) for x in ("A", "b", "AA", "ZZ")] == [0, 1, 26, 701]


def test_letter_column(spark):
    df = spark.range(0, 60).select(letter(F.col("id")).alias("l"), "id")
    assert [r.l for r in df.orderBy("id").collect()] == [letter_of(i) for i in range(60)]


def test_scalar_formats(spark):
    df = spark.createDataFrame([(1234.5, "Network request to host failed", None, 0),
                                (2345.5, "other", 7, 5)], "x double, msg string, code long, z long")
    r = df.select(fmt.thousands("x", 0).alias("a"), fmt.thousands("x", 2).alias("b"),
                  fmt.classify_message("msg").alias("c"), fmt.bank_code("code").alias("d"),
                  fmt.blank_if_falsy("z").alias("e")).collect()
    assert [x.a for x in r] == ["1,234", "2,346"]          # half to even, as Python
    assert [x.b for x in r] == ["1,234.50", "2,345.50"]
    assert r[0].c.startswith("Verificar que el servicio") and r[1].c.startswith("Revisar")
    assert [x.d for x in r] == ["0", "C.7"]
    assert [x.e for x in r] == ["", "5"]


def test_clip_strategy_time(spark):
    df = spark.createDataFrame([("x" * 25, 150.0, 1500), ("short", 5.0, 400000)],
                               "t string, mb double, rows long")
    r = df.select(clip("t").alias("c"), fmt.size_strategy("mb", "rows").alias("s"),
                  fmt.time_estimate("rows").alias("e")).collect()
    assert r[0].c == "x" * 20 + "..." and r[1].c == "short"
    assert (r[0].s.strategy, r[0].s.chunk_size, r[0].s.memory_estimate_mb) == ("streaming", 5000, 45.0)
    assert (r[1].s.strategy, r[1].s.chunk_size) == ("standard", 400000)
    assert r[0].e.human_readable == "0 segundos"               # 0.5 rounds to even
    assert r[1].e.human_readable == "2.2 minutos"


def test_normalize_symbols(spark):
    df = spark.createDataFrame([("🚀 go ✅ 🎪 ⚠️ 😀😀 x ─ 中文",)], "t string")
    out = df.select(normalize_symbols("t").alias("t")).first().t
    assert out == "[COHETE] go [CHECK] [EVENTO] [WARNING] [EMOJI] x ─ 中文"


def test_decode_text(spark):
    df = spark.createDataFrame([(bytearray("﻿cañón".encode("utf-8")),),
                                (bytearray("cañón".encode("latin-1")),)], "b binary")
    assert [r.t for r in df.select(decode_text("b").alias("t")).collect()] == ["cañón", "cañón"]


def test_normalize_symbols_every_entry(spark):
    """Each mapped symbol, alone and amid text, matches a plain Python
    replace chain; texts without any symbol skip the chain unchanged."""
    import re

    from sheetrecon.functions.symbols import EMOJI_MARK, EMOJI_RANGES, SYMBOL_TEXT

    residual = re.compile("[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}"
                                        for a, b in EMOJI_RANGES) + "]+")

    def expected(s):
        if s is None:
            return None
        for sym, text in SYMBOL_TEXT:
            s = s.replace(sym, text)
        return residual.sub(EMOJI_MARK, s)

    texts = [f"a {sym} b" for sym, _ in SYMBOL_TEXT]
    texts += ["plain ascii", "cañón ─ 中文", "😀 only emoji", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.t for r in df.select("i", normalize_symbols("t").alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [expected(t) for t in texts]


def test_text_zero_is_not_falsy(spark):
    df = spark.createDataFrame([("0", 0, 0.0), ("", 7, None)], "a string, b int, c double")
    got = [tuple(r) for r in df.select(*[fmt.blank_if_falsy(x) for x in "abc"]).collect()]
    assert got == [("0", "", ""), ("", "7", "")]


def test_key_columns_past_the_tenth_are_scored(spark):
    cells = ", ".join(f"c{i} string" for i in range(15))
    s = spark.createDataFrame([("f", i, *[None] * 12, str(5000 + i), None, None) for i in range(10, 20)],
                              "file_path string, row_no long, " + cells)
    best = pr.score_key_columns(s).first()
    assert (best.col_ix, best.n_keys, best.col_letter) == (12, 10, "M")
    plan = pr.score_key_columns(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # only the row per file is unpivoted
