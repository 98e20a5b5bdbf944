"""Records, encoding and separator of delimited files, found split by split.

A file is read in parallel splits, so three facts about it are not known where its
lines are read: the number of the first line of a split, the encoding (one for the
whole file), and whether a split begins inside a quoted cell. One aggregate over the
lines gives a row per split that answers all three:

* the lines of the split, summed up over the splits before it;
* whether all its bytes are UTF-8: a file is UTF-8 if all its splits are, else
  ISO-8859-1, which never fails;
* the lines with quotes, each as a transition of two states (inside a quoted cell or
  not, on entry and on exit). Transitions compose, so the state on entry of a split is
  a prefix over the splits of its file, and that of a line a prefix inside its split.

A quote opens a cell only where a cell starts, and only if the next quote that is not
doubled closes it (a separator or the end of the line follows) and the record ends within
``max_lines`` lines; any other quote is text. So a stray quote takes no row with it, and no
record is larger than the bound. Nothing runs while the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.safety import broadcast_if_bounded

FILE, ROW_NO = "file_path", "row_no"
#: Lines of one record at most; a quote that is not closed within them is text.
MAX_LINES = 1000
DETECTED = (",", "\t")
FIRST = Window.unboundedPreceding


def text_lines(scan: DataFrame) -> DataFrame:
    """A text scan with ``file_path, _blk`` (split) and ``value`` -> with ``_id``, which
    counts the lines of a split; the bytes of ``value`` are those of the file."""
    return scan.select(FILE, "_blk", F.monotonically_increasing_id().alias("_id"), "value")


def decode_bytes(value: Column, utf8: Column) -> Column:
    """Text of the bytes of ``value`` in the encoding of its file; a byte-order mark goes."""
    text = F.when(utf8, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))
    return F.regexp_replace(text, "\\A\uFEFF", "")


#: What follows when a line begins inside a quoted cell, up to the quote that ends it.
CONTENT = '[^"]*+(?:""[^"]*+)*+'


def quote_patterns(sep: str) -> tuple[str, str, str]:
    """Patterns of lines: ends inside a quoted cell if it begins outside one; ends the cell
    that it begins in; does so and ends inside another one."""
    s = "".join("\\" + c if not c.isalnum() else c for c in sep) if sep != "\t" else "\\t"
    cells = f'(?:(?:"{CONTENT}"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+'
    opened = f'{cells}"{CONTENT}\\z'
    return f"\\A{opened}", f'\\A{CONTENT}"(?:{s}|\\z)', f'\\A{CONTENT}"{s}{opened}'


def split_table(lines: DataFrame, seps: tuple[str, ...], quotes: bool) -> DataFrame:
    """Lines (``text_lines``) -> a row per split: _first (id), _n (lines), _utf8, _tab (its
    first line holds a tab), _events (id and kind of the lines with quotes: a bit for lines
    with doubled quotes only, three for each of ``seps``; no more than a split has lines)."""
    found = [F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"),
             F.bool_and(F.coalesce(F.is_valid_utf8("value"), F.lit(True))).alias("_utf8"),
             F.min_by(F.col("value").contains("\t"), F.col("_id")).alias("_tab")]
    if quotes:
        patterns = [f"\\A{CONTENT}\\z", *(p for sep in seps for p in quote_patterns(sep))]
        bits = [F.col("value").rlike(p).cast("int") * (1 << i) for i, p in enumerate(patterns)]
        event = F.struct("_id", reduce(lambda a, b: a + b, bits).alias("bits"))
        found.append(F.collect_list(F.when(F.col("value").contains('"'), event)).alias("_events"))
    table = lines.groupBy(FILE, "_blk").agg(*found)
    if not quotes:
        return table
    # every use asks for all columns, so that all of them share one exchange
    flags = F.col("_utf8").cast("int") + F.col("_tab").cast("int")
    return table.where((F.size("_events") + F.col("_n") + flags >= 0) & (F.col("_first") >= 0))


def file_facts(table: DataFrame) -> DataFrame:
    """With ``_before``, the lines of the file before the split; ``_utf8`` and ``_tab`` become
    those of the file."""
    whole = Window.partitionBy(FILE)
    ordered = whole.orderBy("_blk")
    return (table.withColumn("_before", F.coalesce(F.sum("_n").over(ordered.rowsBetween(FIRST, -1)), F.lit(0)))
            .withColumn("_utf8", F.bool_and("_utf8").over(whole))
            .withColumn("_tab", F.first("_tab").over(ordered.rowsBetween(FIRST, Window.unboundedFollowing))))


def odd(n: Column) -> Column:
    return n % 2 == 1


def following(events: DataFrame, name: str, value: Column) -> DataFrame:
    """``events`` with the nearest later ``value`` of the file that is not null (values rise
    with the line), in the same split or in a later one."""
    split = Window.partitionBy(FILE, "_blk").orderBy(F.desc(ROW_NO)).rowsBetween(FIRST, -1)
    events = events.withColumn("_here", value).withColumn("_next", F.min("_here").over(split))
    heads = events.groupBy(FILE, "_blk").agg(F.min("_here").alias("_head"))
    later = Window.partitionBy(FILE).orderBy(F.desc("_blk")).rowsBetween(FIRST, -1)
    heads = heads.select(FILE, "_blk", F.min("_head").over(later).alias("_later"))
    return (events.join(heads, [FILE, "_blk"]).withColumn(name, F.coalesce("_next", "_later"))
            .drop("_here", "_next", "_later"))


def spans(table: DataFrame, detect: bool, max_lines: int) -> DataFrame:
    """``file_facts`` with events -> file_path, _open, _close: first and last line of
    the records of two lines or more."""
    e = F.col("_e.bits")
    kind = F.when(F.col("_tab"), F.shiftright(e, 3)).otherwise(e) if detect else e
    events = (table.select(FILE, "_blk", "_before", "_first", "_tab", F.explode("_events").alias("_e"))
              .select(FILE, "_blk", (F.col("_before") + F.col("_e._id") - F.col("_first") + 1).alias(ROW_NO),
                      odd(e).alias("_pure"), *[odd(F.shiftright(kind, i + 1)).alias(c)
                                               for i, c in enumerate(("_opens", "_ends", "_reopens"))]))
    split = Window.partitionBy(FILE, "_blk")
    near = lambda row: F.coalesce(row - F.col(ROW_NO) < max_lines, F.lit(False))
    events = following(events, "_quote", F.when(~F.col("_pure"), F.struct(ROW_NO, "_ends")))
    good = F.coalesce(F.col("_quote._ends"), F.lit(False)) & near(F.col(f"_quote.{ROW_NO}"))
    events = (events.withColumn("_stays", F.col("_pure") | F.col("_ends") & F.col("_reopens") & good)
              .withColumn("_opens", F.col("_opens") & good))
    # the line that ends the record: the next one that leaves the cell
    events = following(events, "_close", F.when(~F.col("_stays"), F.col(ROW_NO)))
    events = events.withColumn("_opens", F.col("_opens") & near(F.col("_close")))
    # a transition sets the state, flips it, or leaves it
    fixed, flip = F.col("_opens") == F.col("_stays"), F.col("_opens") & ~F.col("_stays")
    upto = split.orderBy(ROW_NO).rowsBetween(FIRST, 0)
    events = (events.withColumn("_flips", F.sum(flip.cast("long")).over(upto))
              .withColumn("_set", F.last(F.when(fixed, F.col("_stays")), ignorenulls=True).over(upto))
              .withColumn("_at", F.last(F.when(fixed, F.col("_flips")), ignorenulls=True).over(upto)))
    inside = F.col("_set") != odd(F.col("_flips") - F.col("_at"))  # null before the first set state
    ends = (events.withColumn("_state", inside).groupBy(FILE, "_blk")
            .agg(F.max_by("_state", ROW_NO).alias("_set"), F.max("_flips").alias("_flips"))
            .withColumn("_flips", F.when(F.col("_set").isNull(), F.col("_flips")).otherwise(F.lit(0))))
    before = Window.partitionBy(FILE).orderBy("_blk").rowsBetween(FIRST, -1)
    ends = (ends.withColumn("_sum", F.sum("_flips").over(Window.partitionBy(FILE).orderBy("_blk").rowsBetween(FIRST, 0)))
            .select(FILE, "_blk", (F.coalesce(F.last("_set", ignorenulls=True).over(before), F.lit(False))
                                   != odd(F.coalesce(F.last("_sum").over(before), F.lit(0)) - F.coalesce(
                                       F.last(F.when(F.col("_set").isNotNull(), F.col("_sum")), ignorenulls=True)
                                       .over(before), F.lit(0)))).alias("_entry")))
    after = F.coalesce(inside, F.col("_entry") != odd(F.col("_flips")))
    events = events.join(ends, [FILE, "_blk"]).withColumn("_after", after)
    was = F.coalesce(F.lag("_after").over(split.orderBy(ROW_NO)), F.col("_entry"))
    return (events.withColumn("_was", was).where(~F.col("_was") & F.col("_after"))
            .select(FILE, F.col(ROW_NO).alias("_open"), "_close"))


def renumbered(table: DataFrame, inner: DataFrame) -> DataFrame:
    """Line numbers of the files with quotes -> file_path, row_no, _record (number of the
    line's record in its file), _several (has the record more lines?), only where these
    differ from a line of its own. No text is read."""
    quoted = F.max(F.size("_events")).over(Window.partitionBy(FILE))
    rows = (table.withColumn("_quoted", quoted).where("_quoted > 0")
            .select(FILE, "_blk", F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n")))
                    .alias(ROW_NO)))
    rows = (rows.join(inner, [FILE, ROW_NO], "left").withColumn("_several", F.col("_open").isNotNull())
            .withColumn("_more", F.coalesce((F.col("_open") < F.col(ROW_NO)).cast("long"), F.lit(0))))
    totals = rows.groupBy(FILE, "_blk").agg(F.sum("_more").alias("_total"))
    before = Window.partitionBy(FILE).orderBy("_blk").rowsBetween(FIRST, -1)
    totals = totals.select(FILE, "_blk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_earlier"))
    upto = Window.partitionBy(FILE, "_blk").orderBy(ROW_NO).rowsBetween(FIRST, 0)
    return (rows.withColumn("_more", F.sum("_more").over(upto)).join(totals, [FILE, "_blk"])
            .select(FILE, ROW_NO, (F.col(ROW_NO) - F.col("_more") - F.col("_earlier")).alias("_record"), "_several")
            .where(f"_several or _record <> {ROW_NO}"))


def numbered(lines: DataFrame, row_bound: int | None = None, table: DataFrame | None = None,
             decode: bool = True) -> DataFrame:
    """``text_lines`` -> file_path, row_no (line of the file), value (text), _tab. The split
    table is broadcast only when ``row_bound`` proves it small."""
    facts = file_facts(split_table(lines, (), False) if table is None else table)
    facts = facts.select(FILE, "_blk", "_first", "_before", "_utf8", "_tab")
    facts = facts if row_bound is None else broadcast_if_bounded(facts, row_bound)
    value = decode_bytes(F.col("value"), F.col("_utf8")) if decode else F.col("value")
    return (lines.join(facts, [FILE, "_blk"])
            .select(FILE, (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias(ROW_NO),
                    value.alias("value"), "_tab"))


def records(lines: DataFrame, sep: str | None = ",", row_bound: int | None = None,
            max_lines: int = MAX_LINES) -> DataFrame:
    """``text_lines`` -> file_path, row_no (number of the record in its file), value (its
    text, with the line breaks of its quoted cells), sep (``sep``, or that of the file:
    a tab if its first line holds one, else a comma).

    The text is read twice, a third time only where a record has several lines. Blank
    lines are records. Only the lines of one record are ever gathered.
    """
    seps = DETECTED if sep is None else (sep,)
    table = split_table(lines, seps, True)
    facts = file_facts(table)
    found = spans(facts, sep is None, max_lines)
    inner = found.select(FILE, F.explode(F.sequence("_open", "_close")).alias(ROW_NO), "_open")
    numbers = renumbered(facts, inner)
    rows = numbered(lines, row_bound, table)
    single = (rows.join(numbers, [FILE, ROW_NO], "left").where(~F.coalesce("_several", F.lit(False)))
              .withColumn("_record", F.coalesce("_record", ROW_NO)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ROW_NO, "value"))),
                                    lambda x: x["value"]), "\n")
    # lines that no record of several lines holds are dropped before they are numbered
    several = (rows.join(inner.select(FILE, ROW_NO), [FILE, ROW_NO], "left_semi")
               .join(numbers, [FILE, ROW_NO]).groupBy(FILE, "_record")
               .agg(text.alias("value"), F.first("_tab").alias("_tab")))
    columns = [FILE, F.col("_record").alias(ROW_NO), "value", "_tab"]
    chosen = F.when(F.col("_tab"), F.lit("\t")).otherwise(F.lit(",")) if sep is None else F.lit(sep)
    return single.select(*columns).unionByName(several.select(*columns)).select(
        FILE, ROW_NO, "value", chosen.alias("sep"))
