"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

A line goes when it repeats an earlier line, or lies within ``edits`` of a line that
first occurs earlier (by document id, text hash and line number; NULL ids first). Lines
under ``min_chars`` characters cannot be told apart by a few edits: they are never joined
by edits. With ``short`` exact repeats of those with a visible character go too (so in the
query and the pipeline); without it they always stay.

Equal lines are one row before anything else. A distinct line is cut into ``edits`` + 1
segments; of two lines within ``edits`` one segment must occur unchanged in the other,
shifted no further than the edits on either side of it allow. So each line is indexed
under its segments and probes the segments of lines of its own length and up to
``edits`` less. Probes that meet are compared by counts of frequent letters inside the
join, so that lines sharing a frequent segment yield no rows, and then verified by the
banded bit-parallel edit distance.

NULL and empty texts have no line to drop. Rows that repeat an id and its text are
judged alike, and keep their lines together.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import materialize

EDITS, MIN_CHARS = 2, 20
# Letters whose counts are compared: fixed, in the order of their frequency in European text.
_LETTERS = "eanirtsoludchmpg"
_OTHERS = "bvfwkz0123456789"
# Words of 64 bits in the filter of wanted lines: a table of this many rows is broadcast.
_FILTER_WORDS = 1 << 17


def _lines(docs: DataFrame, id_column: str) -> DataFrame:
    """(id, at, line_no, line, h, g) of every line; ``at`` tells texts of one id apart."""
    # ``at`` before the lines, or each of them would carry and hash the whole text
    told = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64("text").alias("at"), F.col("text").cast("string").alias("text"))
    lines = told.select("id", "at", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(1), "line")})


def _segment(length: Column, edits: int, number: int) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment: equal parts, the longer ones last."""
    parts = edits + 1
    short, longer = F.floor(length / parts), length % parts
    before = F.greatest(F.lit(0), F.lit(number) - (F.lit(parts) - longer))
    return (short * number + before + 1).cast("int"), (short + (F.lit(number) >= F.lit(parts) - longer).cast("int")).cast("int")


def _piece(wide: Column, start: Column, size: Column) -> Column:
    """Characters of a line in four bytes each, so that a place is found without a walk."""
    return F.substring(wide, start * 4 - 3, size * 4)


def _probe_keys(wide: Column, length: Column, edits: int) -> list[Column]:
    """Substrings that may equal a segment of a line of ``length - less`` characters. The
    first ``edits`` + 1 are the line's own segments, under which it is indexed."""
    own, out = [], []
    for less in range(edits + 1):
        other = length - less
        for number in range(edits + 1):
            start, size = _segment(other, edits, number)
            left, right = number, edits - number  # edits before the segment, and behind it
            for shift in range(max(-left, less - right), min(left, less + right) + 1):
                place = start + shift
                key = F.xxhash64(F.lit(number), other, _piece(wide, place, size))
                if less == shift == 0:
                    own.append(key)
                else:
                    out.append(F.when((place >= 1) & (place + size - 1 <= length), key))
    return own + out


def _letters(line: Column, letters: str = _LETTERS) -> Column:
    """Counts of ``letters`` modulo 16, four bits each. They are taken out one after the
    other, so each pass reads what is left."""
    total, rest = F.lit(0).cast("long"), line
    for place, letter in enumerate(letters):
        before, rest = rest, F.replace(rest, F.lit(letter), F.lit(""))
        count = F.octet_length(before) - F.octet_length(rest)
        total = total.bitwiseOR(F.shiftleft(count.bitwiseAND(15).cast("long"), 4 * place))
    return total


def _may_be_near(a: Column, b: Column, edits: int) -> Column:
    """An edit changes at most two counts by one; counts are known modulo 16."""
    apart = F.lit(0)
    for place in range(len(_LETTERS)):
        one = F.shiftrightunsigned(a, 4 * place).bitwiseAND(15) - F.shiftrightunsigned(b, 4 * place).bitwiseAND(15)
        apart = apart + F.abs(F.pmod(one + 8, F.lit(16)) - 8)
    return apart <= 2 * edits


def edit_distance_within(a: str, b: str, edits: int) -> Column:
    """Are the strings in columns ``a`` and ``b`` within ``edits`` of each other?

    Bit-parallel over the band of 2 ``edits`` + 1 diagonals: per character of ``b`` one
    step on words of vertical differences, which slide along with the main diagonal. The
    distance is followed down the lowest diagonal to the end of ``a``, then along it.
    """
    width = 2 * edits + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)
    same = " + ".join(f"IF(get(t.x, i - {edits - bit}) <=> get(t.y, i), {1 << bit}, 0)" for bit in range(width))
    start = ((1 << (edits + 1)) - 1) << (width - edits - 1)
    last = f"shiftright({top}L, i - t.n + {edits} + 1)"
    # a one-element transform names a value that is used more than once, so it is computed once
    step = f"""
      transform(array(CAST({same} AS BIGINT)), x ->
      transform(array((((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn) & {mask}L)), d ->
      transform(array((s.vn | ~(d | s.vp)) & {mask}L), hp -> named_struct(
        'vp', ((d & s.vp) | ~(shiftright(d, 1) | hp)) & {mask}L,
        'vn', shiftright(d, 1) & hp,
        'dist', s.dist + IF(i < t.n - {edits},
          IF((d & {top}L) = 0, 1, 0),
          IF((hp & {last}) = 0, 0, 1) - IF((d & s.vp & {last}) = 0, 0, 1)))
      )[0])[0])[0]"""
    body = f"""
      transform(array(named_struct('x', split({a}, ''), 'y', split({b}, ''), 'n', char_length({a}), 'm', char_length({b}))),
        t -> aggregate(IF(t.m = 0, array(), sequence(0, t.m - 1)),
          named_struct('vp', {start}L, 'vn', 0L, 'dist', {edits}),
          (s, i) -> {step}, s -> s.dist))[0]"""
    lengths = f"abs(char_length({a}) - char_length({b})) <= {edits}"
    # a string no longer than the band has no lowest diagonal to follow
    return F.expr(f"{lengths} AND IF(char_length({a}) <= {edits}, levenshtein({a}, {b}) <= {edits}, ({body}) <= {edits})")


def _filter(keys: DataFrame) -> DataFrame:
    """Bits of the ``h`` of ``keys``, for ``_wanted``. The filter's size is fixed, whatever the input."""
    word = F.col("h").bitwiseAND(_FILTER_WORDS - 1)
    ones = keys.select("h").groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(shiftrightunsigned(h, 40) & 63 AS INT))")).alias("ones"))
    return materialize(ones, "filter")


def _wanted(lines: DataFrame, ones: DataFrame) -> DataFrame:
    """Those of ``lines`` whose ``h`` may be among a filter's keys: few others pass it, none
    of the keys' own is lost."""
    held = lines.withColumn("word", F.col("h").bitwiseAND(_FILTER_WORDS - 1)).join(F.broadcast(ones), "word")
    return held.where(F.expr("(ones & shiftleft(1L, CAST(shiftrightunsigned(h, 40) & 63 AS INT))) <> 0")).drop("word", "ones")


def _among(lines: DataFrame, keys: DataFrame, ones: DataFrame) -> DataFrame:
    """Those of ``lines`` whose ``h`` is among the distinct ``keys``. Not a semi-join: the
    planner moves that below the filter, and then all lines are shuffled."""
    return _wanted(lines, ones).join(keys, "h")


@contextmanager
def _compiled_methods(spark: SparkSession) -> Iterator[None]:
    """The JVM never compiles methods of over 8000 bytes: let Spark split what is longer."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _near(lines: DataFrame, distinct: DataFrame, edits: int) -> DataFrame:
    """Keys (h, g) of distinct lines with an earlier line within ``edits``."""
    probe = _probe_keys(F.col("wide"), F.col("length"), edits)
    told = lines.select("h", "g", _letters(F.col("line")).alias("letters"), F.encode("line", "UTF-32").alias("wide"))
    keyed = told.withColumn("length", F.shiftright(F.octet_length("wide"), 2)).select(
        "h", "g", F.struct("letters", F.array(*probe).alias("probe")).alias("x")
    )
    # one struct: both sides of the join then read the same shuffle
    once = keyed.groupBy("h", "g").agg(F.first("x").alias("x"))
    shelf = once.select(F.col("h").alias("b"), F.col("x.letters").alias("b_letters"), F.explode(F.slice("x.probe", 1, edits + 1)).alias("k"))
    asked = once.select(F.col("h").alias("a"), F.col("x.letters").alias("a_letters"), F.explode("x.probe").alias("k"))
    met = asked.where("k IS NOT NULL").join(
        shelf, (asked.k == shelf.k) & (F.col("a") != F.col("b")) & _may_be_near(F.col("a_letters"), F.col("b_letters"), edits)
    )
    with _compiled_methods(lines.sparkSession):
        pairs = materialize(met.select("a", "b").distinct(), "line-pairs")
    keys = materialize(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "line-keys")
    ones = _filter(keys)
    texts = _among(lines.select("h", "g", "line"), keys, ones).dropDuplicates(["h", "g"])
    firsts = _among(distinct.select("h", "g", "first"), keys, ones)
    # other characters are counted in the few lines that are left
    known = texts.join(firsts, ["h", "g"]).withColumn("others", _letters(F.col("line"), _OTHERS))
    known = materialize(known, "line-texts")

    def side(name: str) -> DataFrame:
        return known.select(*[F.col(c).alias(name if c == "h" else f"{name}_{c}") for c in known.columns])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    likely = _may_be_near(F.col("a_others"), F.col("b_others"), edits)
    near = both.where(likely & edit_distance_within("a_line", "b_line", edits)).select(
        F.when(F.col("a_first") > F.col("b_first"), F.struct(F.col("a").alias("h"), F.col("a_g").alias("g")))
        .otherwise(F.struct(F.col("b").alias("h"), F.col("b_g").alias("g"))).alias("later")
    )
    return near.select("later.h", "later.g").distinct()


def duplicate_lines(docs: DataFrame, id_column: str = "doc_id", edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """(id, at, dropped): the numbers (from 0) of the lines to drop, per document with any."""
    every = _lines(docs, id_column)
    long_ = every.where(F.char_length("line") >= min_chars)
    grouped = every.where((F.char_length("line") >= min_chars) | F.col("line").rlike(r"\S")) if short else long_
    occurrence = F.struct("id", "at", "line_no")
    distinct = materialize(
        grouped.groupBy("h", "g").agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last")), "lines"
    )
    near = materialize(_near(long_, distinct, edits), "near-lines")
    bad = materialize(
        distinct.join(near.withColumn("near", F.lit(True)), ["h", "g"], "left")
        .where("near OR NOT first <=> last")
        .select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "bad-lines",
    )
    narrow = _wanted(grouped.select("id", "at", "line_no", "h", "g"), _filter(bad))
    dropped = narrow.join(bad, ["h", "g"]).where(F.col("near") | ~occurrence.eqNullSafe(F.col("first")))
    return materialize(
        dropped.groupBy("id", "at").agg(F.array_sort(F.collect_set("line_no")).alias("dropped")), "dropped-lines"
    )


def report(
    docs: DataFrame, id_column: str = "doc_id", edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False
) -> DataFrame:
    """Every row as (id, n_lines, n_dropped, dropped)."""
    dropped = duplicate_lines(docs, id_column, edits, min_chars, short)
    counted = docs.select(
        F.col(f"`{id_column}`").alias("row_id"), F.xxhash64("text").alias("text_at"),
        F.coalesce(F.size(F.split(F.col("text").cast("string"), "\n")), F.lit(0)).alias("n_lines"),
    )
    counted = counted.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    found = counted.join(
        dropped, F.col("row_id").eqNullSafe(dropped["id"]) & (F.col("text_at") == dropped["at"]), "left"
    )
    return found.select(
        F.col("row_id").alias(id_column), "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def without_duplicate_lines(
    docs: DataFrame, id_column: str = "doc_id", edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False
) -> DataFrame:
    """``docs`` with the duplicate lines cut out of ``text``. A document that loses lines
    and is left without any visible character goes; all other rows stay."""
    columns = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(columns)])
    text, own = f"c{columns.index('text')}", f"c{columns.index(id_column)}"
    dropped = duplicate_lines(inner.select(F.col(own).alias("row_id"), F.col(text).alias("text")), "row_id", edits, min_chars, short)
    keyed = inner.withColumn("text_at", F.xxhash64(text))
    found = keyed.join(dropped, F.col(own).eqNullSafe(dropped["id"]) & (F.col("text_at") == dropped["at"]), "left")
    kept = F.array_join(
        F.filter(F.split(text, "\n"), lambda _, place: ~F.array_contains(F.col("dropped"), place)), "\n"
    )
    cut = found.withColumn(text, F.when(F.col("dropped").isNull(), F.col(text)).otherwise(kept))
    cut = cut.where(F.col("dropped").isNull() | F.col(text).rlike(r"\S"))
    return cut.select(*[F.col(f"c{n}").alias(c) for n, c in enumerate(columns)])
