"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line goes when an earlier one (by document id, then line number) is equal or one edit away: one code
point put in, left out or replaced. All lines that aren't blank are compared for equality. Lines of fewer than
`LEAST` characters after trimming have no neighbours one edit away, as short ones are that by chance.

Two lines are one edit apart if both give one text z when the character at place i is left out (one
replaced), or if one of them is z and the other gives it (one left out). So a line emits a key of (z, i) for each
of its places, and one of (itself, i) for each place where a longer line may have one character more. All lines
that emit a key are one edit apart from each other, so the earliest of them is told by one window over the
keys, and no pairs are made; what it tells is verified on the
texts: with the place of the edit known, the edit distance is told in one pass. The key hashes what lies before the
segment of place i, the segment, and what lies behind it; with segments of about the square root of the
length a very long line costs its length to the power 1.5.

Ahead of that, lines that can't have a partner are left out, exactly: the edit leaves the beginning or the end
as it is, so partners of lengths L, L or L, L + 1 share the first half of L characters or the last, and the
edit is in the other. Each line has these two keys for its own length and the next smaller one; those
that two lines of fitting lengths have tell which lines emit variants, and at which places. All this is done with
hashes; texts are read again only of lines that may have a partner.

Defined results: a null text has no line, an empty one a single empty line, which stays, as all blank ones do;
rows that share an id are ordered by a hash of their text, and rows that are equal in both keep their lines as
one row does; rows with null ids come first; an empty table gives no rows; further columns are not read.
Equality of lines is that of 128 bits of hashes, that of variants of 64 bits, their place and length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.scratch import fresh, written

LEAST = 20
#: Lines are trimmed by these characters for their length only.
BLANK = " \t\r\f\v"
SALT = 0x5DEECE66D
#: Binary logarithm of the 64-bit words of the filter of line keys, and bits wanted for each key. With more keys than
#: that allows, the filter lets more lines pass into the join behind it, which is exact by itself.
FILTER_WORDS = 19
FILTER_BITS = 12
#: Shortest segment of a line.
SEGMENT = 16


def lines_of(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, row (a hash of the text, to tell rows of one id apart), line number and line."""
    text = F.col(text_column)
    return frame.where(text.isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("row"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    )


def _comparable(least: int) -> Column:
    return F.length(F.trim(F.translate("line", BLANK, " " * len(BLANK)))) >= least


def _key(text: Column) -> tuple[Column, Column]:
    """128 bits of a line, as two integers."""
    return F.xxhash64(text), F.xxhash64(text, F.lit(SALT))


def _halves() -> Column:
    """Keys of the line's first and last half, as a line of its own length and of the next smaller one.

    A struct for each: hash, whether the length is its own, whether the half is the first one.
    """
    line, n = F.col("line"), F.length("line")

    def half(own: bool, first: bool) -> Column:
        size = n if own else n - 1
        cut = F.floor(size / 2).cast("int")
        part = F.substring(line, F.lit(1), cut) if first else F.substring(line, n - (size - cut) + 1, size - cut)
        return F.struct(
            F.xxhash64(F.lit(first), size, part).alias("half"), F.lit(own).alias("own"), F.lit(first).alias("first")
        )

    return F.array(*[half(own, first) for own in (True, False) for first in (True, False)])


def _keys(less: int, low: Column, high: Column) -> Column:
    """(key, place, size) of the line without the character at each place from `low` to `high` (`less` 1),
    or of the line itself with a gap at each (`less` 0)."""
    line, n = F.col("line"), F.col("n")
    size, step = n - less, F.col("drop_step" if less else "gap_step")

    def segment(j: Column) -> Column:
        begin = j * step
        return F.struct(
            begin.alias("begin"),
            F.xxhash64(F.substring(line, F.lit(1), begin)).alias("before"),
            F.substring(line, begin + 1, step + less).alias("own"),
            F.xxhash64(F.substring(line, begin + step + less + 1, n)).alias("behind"),
        )

    def within(x: Column) -> Column:
        def variant(i: Column) -> Column:
            at = i - x["begin"]
            own = x["own"]
            if less:
                own = F.concat(F.substring(own, F.lit(1), at), F.substring(own, at + 2, step))
            return F.struct(
                F.xxhash64(i, x["before"], own, x["behind"]).alias("key"), i.alias("at"), size.alias("size")
            )

        return F.transform(
            F.sequence(F.greatest(low, x["begin"]), F.least(high, x["begin"] + step - 1)), variant
        )

    of = lambda i: F.floor(i / step).cast("int")
    every = F.flatten(F.transform(F.transform(F.sequence(of(low), of(high)), segment), within))
    return F.when(low <= high, every).otherwise(F.array().cast("array<struct<key:bigint,at:int,size:int>>"))


def _variants() -> Column:
    """All keys of a line, at the places that `drop_low`, `drop_high`, `gap_low` and `gap_high` tell."""
    n = F.col("n")
    ends = []
    for less, kind in ((1, "drop"), (0, "gap")):
        cuts = F.floor((n - less) / 2).cast("int"), F.floor(n / 2).cast("int")
        some = F.col(f"{kind}_low") | F.col(f"{kind}_high")
        low = F.when(F.col(f"{kind}_low"), 0).otherwise(cuts[0])
        high = F.when(F.col(f"{kind}_high"), n - less).otherwise(cuts[1] - 1)
        ends.append(_keys(less, low, F.when(some, high).otherwise(-1)))
    return F.concat(*ends)


def _one_edit() -> Column:
    """Whether `line` (of n characters) and `other` (of m) are equal but for one edit at place `at`.

    The general edit distance of Spark costs the product of the lengths; at a known place it is one pass.
    """
    line, other, at = F.col("line"), F.col("other"), F.col("at")
    longest = F.greatest("n", "m")

    def behind(text: Column, size: str) -> Column:
        return F.substring(text, at + 2 - (longest - F.col(size)), longest)

    begins = F.substring(line, F.lit(1), at) == F.substring(other, F.lit(1), at)
    return begins & (behind(line, "n") == behind(other, "m")) & (F.abs(F.col("n") - F.col("m")) <= 1)


def _bits(key: str, words: int) -> tuple[Column, Column]:
    mask = F.lit((1 << (6 + words)) - 1)
    return F.col(key).bitwiseAND(mask), F.shiftrightunsigned(F.col(key), 64 - 6 - words)


def _passes(keys: DataFrame, key: str) -> Column:
    """False only for values of `key` that `keys` does not have: a Bloom filter as one array, which a scalar
    subquery computes; its size follows the keys, up to 2**FILTER_WORDS words. It spares a join's shuffle
    most rows without a partner."""
    words = min(FILTER_WORDS, max(4, (keys.count() * FILTER_BITS >> 6).bit_length()))
    bits = keys.select(F.explode(F.array(*_bits(key, words))).alias("bit"))
    held = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("held")
    )
    every = keys.sparkSession.range(1 << words).withColumnRenamed("id", "word")
    pairs = F.collect_list(F.struct("word", F.coalesce("held", F.lit(0).cast("long")).alias("held")))
    table = every.join(held, "word", "left").agg(F.transform(F.array_sort(pairs), lambda x: x["held"]).alias("t"))
    one, two = (
        F.call_function("getbit", F.element_at(table.scalar(), F.shiftright(bit, 6).cast("int") + 1), (bit % 64).cast("int")) == 1
        for bit in _bits(key, words)
    )
    return one & two


def _partners(table: DataFrame) -> DataFrame:
    """k1, k2 of the lines that share a half with another of fitting length, and where an edit may then be."""
    halves = table.select("k1", "k2", F.inline("halves"))
    own, other = F.col("own"), ~F.col("own")
    met = halves.groupBy("half").agg(
        F.min(F.when(own, F.col("k1"))).alias("least"), F.max(F.when(own, F.col("k1"))).alias("most"),
        F.max(other).alias("longer"),
    ).where("least <> most OR (least IS NOT NULL AND longer)")
    met = written(met.select("half", F.expr("least <> most").alias("several"), "longer"), "line-halves")
    # a line of the own length meets others of it, and longer ones; a longer line meets any of that length
    drop, gap = other | F.col("several"), own & F.col("longer")
    where = {"low": ~F.col("first"), "high": F.col("first")}
    flags = {f"{kind}_{end}": may & at for kind, may in (("drop", drop), ("gap", gap)) for end, at in where.items()}
    found = halves.join(met, "half").select("k1", "k2", *[x.alias(c) for c, x in flags.items()])
    return found.groupBy("k1", "k2").agg(*[F.max(c).alias(c) for c in flags])


def repeated_lines(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   least: int = LEAST) -> DataFrame:
    """Every line that goes: id, row, line_no, n_chars, and the earliest line it repeats, with the edits."""
    one, two = _key(F.col("line"))
    place = ["id", "row", "line_no"]
    lines = lines_of(frame, id_column, text_column).where(_comparable(1))
    keyed = lines.select(*place, one.alias("k1"), two.alias("k2"), "line")
    # every line by its hashes alone; texts are read again only of those that may have partners
    halves = F.when(_comparable(least), _halves())
    table = written(
        keyed.select(*place, "k1", "k2", F.length("line").alias("n_chars"), halves.alias("halves")), "lines"
    )
    distinct = table.groupBy("k1", "k2").agg(F.min(F.struct(*place)).alias("place"), F.count(F.lit(1)).alias("times"))
    partners = written(_partners(table), "line-partners")
    # one row for each line and task goes into the shuffle, however often the line occurs
    texts = keyed.where(_passes(partners, "k1")).groupBy("k1", "k2").agg(
        F.min(F.struct(*place)).alias("place"), F.first("line").alias("line")
    )
    # lengths are columns of the written table, not worked out again for each variant
    n = F.length("line")
    steps = {f"{kind}_step": F.greatest(F.lit(SEGMENT), F.ceil(F.sqrt(n - less)).cast("int")) for less, kind in enumerate(("gap", "drop"))}
    near = written(texts.join(partners, ["k1", "k2"]).drop("k1", "k2").withColumns({"n": n, **steps}), "line-texts")
    variants = near.select("place", F.inline(_variants()))
    same = Window.partitionBy("key", "at", "size")
    pairs = (
        variants.withColumn("earlier", F.min("place").over(same)).where("earlier < place")
        .groupBy("place", "earlier").agg(F.min("at").alias("at"))
    )
    own = near.select("place", "line", "n")
    other = own.select(F.col("place").alias("earlier"), F.col("line").alias("other"), F.col("n").alias("m"))
    similar = (
        pairs.join(own, "place").join(other, "earlier").where(_one_edit())
        .groupBy("place").agg(F.min("earlier").alias("earlier"))
    )
    known = (
        distinct.join(similar, "place", "left")
        .where("times > 1 OR earlier IS NOT NULL")
        .select("k1", "k2", F.coalesce("earlier", "place").alias("first"),
                F.col("earlier").isNotNull().cast("int").alias("edits"))
    )
    return (
        table.join(known, ["k1", "k2"])
        .where(F.struct(*place) != F.col("first"))
        .select(
            F.col("id").alias(id_column), "row", "line_no", "n_chars", F.col("first.id").alias(f"first_{id_column}"),
            F.col("first.line_no").alias("first_line_no"), "edits",
        )
    )


def without_lines(frame: DataFrame, gone: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """The rows without the given lines, all columns; rows that lose all their lines go."""
    key, row, numbers = (fresh(frame, c) for c in ("__id", "__row", "__gone"))
    dropped = gone.groupBy(F.col(id_column).alias(key), F.col("row").alias(row)).agg(
        F.collect_set("line_no").alias(numbers)
    )
    same = F.col(id_column).cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(text_column) == F.col(row))
    joined = frame.join(dropped, same, "left")
    lines = F.split(text_column, "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(numbers, i)), "\n")
    text = F.when(F.col(numbers).isNull(), F.col(text_column)).otherwise(kept)
    whole = F.col(numbers).isNull() | (F.size(numbers) < F.size(lines))
    return joined.where(whole).select(
        *[text.alias(c) if c == text_column else F.col(c) for c in frame.columns]
    )
