"""Line dedup by deletion neighbourhoods, with DataFrame functions only.

A line is removed if an earlier line equals it, or differs from it by at most one word (inserted, deleted or replaced;
only lines of ``MIN_WORDS`` words or more, so that one word is a small part). Earlier means: a smaller id, then
a smaller text hash, then a smaller line number; every comparison is made on the input. Lines are the parts between
line feeds, without the blanks around them, words the parts between blanks. Lines without words stay.

Equal lines are one row before anything else. Each line then emits the hash of the line without word i, for every i,
as a key (v, i), and of itself as (v): equal (v, i) means a replaced word, a (v, i) that equals a (v) an
inserted one. A group's earliest line is the only candidate for all its other members, so a group of any size takes
linear work and no pairs. Candidates are verified by their edit distance: common prefix plus common suffix cover all but
one word.

Before the variants are made, lines that cannot have a partner are left out without loss: one edit leaves the first or the last
half of the words as it is, so a line whose halves (for its own number of words and one more) occur in no other line has
no partner.

Null and empty texts stay as they are, with no line removed. A null id comes first. Rows equal in id and text count as one row and
get the same result. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.columns import ROW, packed

MIN_WORDS = 8
LOWEST = -(1 << 63)


def _line_rows(docs: DataFrame) -> DataFrame:
    """(_id, _h, _line, _norm) for every line that has words."""
    lines = docs.select("_id", "_h", F.posexplode(F.split("_text", "\n")).alias("_line", "_norm"))
    return lines.withColumn("_norm", F.trim("_norm", F.lit(" \t\r\v\f"))).filter("_norm != ''")


def _half_keys(norm: Column, n: Column) -> Column:
    """Hashes of the first half (even) and the last half (odd) for pairs whose longer line has n or n + 1 words.

    For such a longer line of b words the first half has b // 2 words and the last half b - b // 2, so that one
    edit leaves one of them as it is. Of the four halves for b = n and b = n + 1 two are the same.
    """
    half = F.floor(n / 2).cast("int")
    odd = n % 2

    def key(last: Column, count: Column) -> Column:
        part = F.call_function("substring_index", norm, F.lit(" "), F.when(last == 1, -count).otherwise(count))
        return F.xxhash64(count, part).bitwiseAND(F.lit(-2)).bitwiseOR(last.cast("bigint"))

    return F.array(key(F.lit(0), half), key(F.lit(1), half + 1), key(1 - odd, half + odd))


def _agree(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b)))


def within_one_word(a: Column, b: Column) -> Column:
    """Whether the edit distance of two word arrays is at most 1."""
    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (_agree(a, b) + _agree(F.reverse(a), F.reverse(b)) >= longest - 1)


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, dealt: DataFrame | None = None) -> DataFrame:
    """(_id, _h, _gone): numbers of the removed lines per row of ``docs`` (_id, _h, _text), rows without any left out.

    ``dealt`` may hold the same rows dealt by _id and _h.
    """
    lines = _line_rows(docs)
    n = (F.length("_norm") - F.length(F.replace(F.col("_norm"), F.lit(" "), F.lit(""))) + 1).cast("int")
    at = F.struct("_id", "_h", "_line")
    keyed = lines.withColumn("_n", n).select(
        F.xxhash64("_norm").alias("_a"), F.xxhash64("_norm", F.lit(1)).alias("_b"), at.alias("_at"),
        F.when(F.col("_n") >= min_words, _half_keys(F.col("_norm"), F.col("_n"))).alias("_keys"))
    positions = keyed.select("_a", "_b", "_at")
    # The keys of equal lines are equal; they are fields so that the aggregate needs no arrays.
    first = keyed.groupBy("_a", "_b").agg(F.min("_at").alias("_first"), *(
        F.max(F.col("_keys")[k]).alias(f"_k{k}") for k in range(3)))
    # Every reader of ``first`` names all its columns, in a condition that always holds: Spark shares a shuffle only
    # between equal plans, and would prune them differently.
    first = first.filter(F.coalesce(F.xxhash64("_k0", "_k1", "_k2", "_first"), F.lit(0)) >= LOWEST)

    # A collision in _a alone only lets a line pass that has no partner.
    halves = first.filter(F.col("_k0").isNotNull()).select("_a", F.explode(F.array("_k0", "_k1", "_k2")).alias("_k"))
    shared = halves.groupBy("_k").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("_k")
    # Which half stays the same: bit 1 the first, bit 2 the last.
    same = F.bit_or(F.col("_k").bitwiseAND(F.lit(1)) + 1).alias("_same")
    hopeful = first.filter(F.col("_k0").isNotNull()).select("_a", "_first").join(
        halves.join(shared, "_k", "left_semi").groupBy("_a").agg(same), "_a")

    # Words of the hopeful lines, read at their first place. A line is known by that place from here on.
    # An explicit exchange follows what several branches read, so that they share its shuffle.
    wanted = hopeful.groupBy(F.col("_first._id").alias("_id"), F.col("_first._h").alias("_h")).agg(
        F.collect_list(F.struct(F.col("_first._line").alias("line"), "_same")).alias("_wanted"))
    found = (docs if dealt is None else dealt).join(wanted, ["_id", "_h"]).select("_id", "_h", F.split("_text", "\n").alias("_parts"), F.explode("_wanted").alias("_w"))
    words = found.select(F.struct("_id", "_h", F.col("_w.line").alias("_line")).alias("_first"), "_w._same", F.split(F.trim(
        F.element_at("_parts", F.col("_w.line") + 1), F.lit(" \t\r\v\f")), " ").alias("_words")).repartition("_first")

    hashed = words.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    size = F.size("_hashes")
    half = F.floor(size / 2).cast("int")
    places = F.sequence(F.when(F.col("_same") == 1, half).otherwise(0), F.when(F.col("_same") == 2, half).otherwise(size - 1))
    variants = F.transform(places, lambda i: F.struct(
        F.xxhash64(F.slice("_hashes", F.lit(1), i), F.slice("_hashes", i + 2, size)).alias("v"), i.alias("i")))
    whole = F.struct(F.xxhash64("_hashes", F.lit(None).cast("array<bigint>")).alias("v"), F.lit(-1).alias("i"))
    emitted = hashed.select("_first", F.explode(F.concat(F.array(whole), variants)).alias("_v")).select("_v.v", "_v.i", "_first")
    # Earliest line per (v, i); of a v, the line that is v itself (i = -1) and the earliest that is v with a word more.
    best = emitted.groupBy("v", "i").agg(F.min("_first").alias("_best"), F.count(F.lit(1)).alias("_c")).repartition("v")
    around = best.groupBy("v").agg(F.min(F.when(F.col("i") >= 0, F.col("_best"))).alias("_longer"),
                                   F.min(F.when(F.col("i") < 0, F.col("_best"))).alias("_shorter"), F.max("_c").alias("_most")).filter(
        "_most > 1 or (_longer is not null and _shorter is not null)")
    met = best.join(around, "v").filter("_c + _most > 0").select("v", "i", F.array_distinct(F.array(
        "_best", F.when(F.col("i") < 0, F.col("_longer")).otherwise(F.col("_shorter")))).alias("_bests"))
    pairs = emitted.join(met, ["v", "i"]).select("_first", F.explode("_bests").alias("_best")).filter("_best < _first").distinct()
    own = words.select("_first", "_words", "_same")
    other = words.select(F.col("_first").alias("_best"), F.col("_words").alias("_others"), F.col("_same").alias("_also"))
    near = pairs.join(own, "_first").join(other, "_best").filter(
        within_one_word(F.col("_words"), F.col("_others")) & (F.col("_same") + F.col("_also") > 0)).select("_first").distinct()

    # A repeated line goes everywhere but at its first place, and there too if an earlier line is near.
    gone = positions.join(first.select("_a", "_b", "_first"), ["_a", "_b"]).filter(F.col("_first") != F.col("_at")).select(
        "_at").unionByName(near.select(F.col("_first").alias("_at")))
    return gone.groupBy(F.col("_at._id").alias("_id"), F.col("_at._h").alias("_h")).agg(
        F.array_sort(F.collect_list("_at._line")).alias("_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the removed lines taken out of the text, ``n_lines`` and ``lines_removed`` (which replace columns of those names)."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    table = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LOWEST)).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"),
        F.col(text_col).alias("_text"), F.struct(*others).alias("_others") if others else F.lit(None).cast("int").alias("_others"))
    # The texts cross one shuffle: lines are read from it, and cut from it. Both readers see all its columns (the
    # condition always holds), since Spark shares an exchange only between equal plans.
    dealt = table.repartition("_id", "_h")
    gone = removed_lines(table.select("_id", "_h", "_text"), min_words,
                         dealt.filter(F.xxhash64("_others") >= LOWEST).select("_id", "_h", "_text") if others else dealt)
    parts = F.split("_text", "\n")
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    whole = dealt.filter(F.xxhash64("_others") >= LOWEST) if others else dealt
    out = whole.join(gone, ["_id", "_h"], "left").withColumns({
        "n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("bigint"),
        "lines_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
        id_col: F.when(F.col("_id") != LOWEST, F.col("_id")),
        text_col: F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(left),
    })
    return out.select(*(F.col("_others")[c].alias(c) if c in others else F.col(c) for c in docs.columns if c not in ("n_lines", "lines_removed")),
                      "n_lines", "lines_removed")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` without the lines that an earlier one has; ``length_col``, if there, follows the text.

    A document that loses every line with words, such as a later exact copy, is dropped: nothing of its own is left. The other
    columns stay as they are.
    """
    rest = docs.select(id_col, text_col, packed(docs, [id_col, text_col]))
    emptied = (F.col("lines_removed") > 0) & (F.trim(F.col(text_col), F.lit(" \t\r\v\f\n")) == "")
    out = dedup_lines(rest, id_col, text_col).filter(~emptied)
    length = F.coalesce(F.length(text_col), F.lit(0)).cast("bigint")
    return out.select(*(F.col(c) if c in (id_col, text_col) else length.alias(c) if c == length_col else F.col(ROW)[c].alias(c) for c in docs.columns))
