"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text, as built-in expressions.

Leaves are runs of words of a paragraph (a line) that end with a word whose hash is a multiple of ``LEAF_WORDS``, so that they
have about so many words and fall into step again behind an edit; paragraphs are hashed whole; a paragraph whose hash
starts with 0, 1, 2 or 3 closes a section, so that an inserted paragraph changes one section only; sections hash
their paragraphs' hashes, and the root hashes the sections'. Equal roots mean equal texts, and where roots differ the
branches that differ locate the edit. ``likeness`` is the Dice share of common leaves.

Null texts are read as empty: one empty paragraph, one leaf. Rows that repeat have equal trees. In ``successors``
rows follow in ascending key; rows without a key come first, in the order of a hash of their text;
rows with the same key in that order too; the last row is followed by the first (a single row by itself).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, shuffle_width

LEAF_WORDS = 4


def _paragraph(p: Column) -> Column:
    def of(words: Column) -> Column:
        n = F.size(words)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.pmod(F.xxhash64(words[i - 1]), F.lit(LEAF_WORDS)) == 0))
        return let(ends, lambda e: F.zip_with(F.concat(F.array(F.lit(0)), e), e, leaf(words)))

    def leaf(words: Column):
        # The list of starts is one longer than that of the ends.
        return lambda before, end: F.when(end.isNotNull(), F.right(F.hex(F.xxhash64(F.slice(words, before + 1, end - before))), F.lit(8)))

    return F.struct(F.md5(p.cast("binary")).alias("hash"), F.array_compact(let(F.split(p, " "), of)).alias("leaves"))


def _sections(paragraphs: Column) -> Column:
    def of(ends: Column) -> Column:
        starts = F.concat(F.array(F.lit(1)), F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: e + 1))

        def section(first: Column, last: Column) -> Column:
            return let(
                F.slice(paragraphs, first, last - first + 1),
                lambda part: F.struct(F.md5(F.array_join(F.transform(part, lambda p: p["hash"]), "").cast("binary")).alias("hash"), part.alias("paragraphs")),
            )

        return F.zip_with(starts, ends, section)

    n = F.size(paragraphs)
    return let(F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (paragraphs[i - 1]["hash"] < F.lit("4"))), of)


def tree(text: Column) -> Column:
    """The tree of a text: ``root``, ``sections`` (hash, paragraphs (hash, leaves))."""
    return let(
        let(F.transform(F.split(text, "\n"), _paragraph), _sections),
        lambda s: F.struct(F.sha2(F.array_join(F.transform(s, lambda x: x["hash"]), "").cast("binary"), 256).alias("root"), s.alias("sections")),
    )


def leaves(of: Column) -> Column:
    return F.flatten(F.transform(of["sections"], lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"]))))


def encode(of: Column) -> Column:
    """The tree as text: root, then ``/section`` and ``,paragraph.leaves`` with eight digits each."""
    return F.concat(
        of["root"],
        F.array_join(
            F.transform(
                of["sections"],
                lambda s: F.concat(
                    F.lit("/"),
                    F.left(s["hash"], F.lit(8)),
                    F.array_join(
                        F.transform(s["paragraphs"], lambda p: F.concat(F.lit(","), F.left(p["hash"], F.lit(8)), F.lit("."), F.lower(F.array_join(p["leaves"], "")))), ""
                    ),
                ),
            ),
            "",
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Dice share of the distinct leaves that two lists of leaves have in common: 0 to 1, and 1 for equal lists."""
    both = F.size(F.array_intersect(a, b))
    return 2.0 * both / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)))


def differing(a: Column, b: Column) -> Column:
    """Places (from 0) of the paragraphs of tree ``a`` whose hash tree ``b`` doesn't have: where the edit is."""

    def hashes(t: Column) -> Column:
        return F.flatten(F.transform(t["sections"], lambda s: F.transform(s["paragraphs"], lambda p: p["hash"])))

    return F.when(a["root"] == b["root"], F.array().cast("array<int>")).otherwise(
        let(hashes(b), lambda known: F.filter(F.transform(hashes(a), lambda h, i: F.when(~F.array_contains(known, h), i)), lambda i: i.isNotNull()))
    )


def _bucket(key: Column, mixed: Column, bounds: list[int], width: int) -> Column:
    """The number of bounds up to the key, by binary search; rows without a key are dealt below zero."""
    steps, size = [], 1
    while size <= len(bounds):
        steps.insert(0, size)
        size *= 2
    if not steps:
        found = F.lit(0)
    else:
        all_bounds = F.expr(f"array({', '.join(f'{b}L' for b in bounds)})")
        found = let(
            all_bounds,
            lambda at: F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda acc, s: acc + F.when(F.coalesce(F.get(at, acc + s - 1) <= key, F.lit(False)), s).otherwise(0)),
        )
    return F.when(key.isNull(), -1 - F.pmod(mixed, F.lit(width)).cast("int")).otherwise(found)


def successors(rows: DataFrame, key: str = "key", value: str = "value", buckets: int | None = None) -> DataFrame:
    """``key``, ``bucket``, ``value``, ``next`` (the value of the row that follows) for rows of a long key and a text.

    Rows are dealt into ranges of the key with about equal numbers of rows, eight for each shuffle partition, and meet
    their successor inside; the first row of a range is also dealt to the range before. What the driver sees is the
    range table, whose size is the number of ranges.
    """
    return _follow(_dealt(rows.select(F.col(key).cast("long").alias("key"), F.col(value).alias("value")), buckets))


def _dealt(rows: DataFrame, buckets: int | None = None) -> DataFrame:
    spark = rows.sparkSession
    width = buckets or 8 * shuffle_width(spark)
    cuts = rows.agg(F.percentile_approx("key", [k / width for k in range(1, width)] or [0.5], max(10_000, 10 * width))).first()[0] or []
    rows = rows.withColumn("mixed", F.xxhash64("value"))
    rows = rows.withColumn("bucket", _bucket(F.col("key"), F.col("mixed"), sorted(set(cuts)), width))
    place = F.struct("key", "mixed")
    ranges = sorted((r["bucket"], r["first"]["key"], r["first"]["mixed"]) for r in rows.groupBy("bucket").agg(F.min(place).alias("first")).collect())
    before = [ranges[k - 1][0] for k in range(len(ranges))]
    borders = spark.createDataFrame(
        [(b, into, k, m) for (b, k, m), into in zip(ranges, before)], "bucket int, into int, first long, first_mixed long"
    )
    # The range table has one row a range: as many as the shuffle is wide, times eight.
    at_border = (rows["bucket"] == borders["bucket"]) & rows["key"].eqNullSafe(F.col("first")) & (rows["mixed"] == F.col("first_mixed"))
    firsts = rows.join(F.broadcast(borders), at_border).select("key", "value", "mixed", F.col("into").alias("bucket")).dropDuplicates(["bucket"])
    return rows.select("key", "value", "mixed", "bucket", F.lit(0).alias("border")).union(firsts.select("key", "value", "mixed", "bucket", F.lit(1)))


def _follow(dealt: DataFrame, more: list[str] = ()) -> DataFrame:
    order = "partition by bucket order by border, key nulls first, mixed"
    ahead = [F.expr(f"lead({c}) over ({order})").alias(f"next_{c}" if c != "value" else "next") for c in ["value", *more]]
    return dealt.select("key", "bucket", "value", *more, "border", *ahead).where("border = 0").drop("border")


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``value``, ``tree``, ``edited`` (text), ``edited_tree``, ``near_edited``, ``near_next`` of each row.

    The edited text has the last half of its code points (rounded down) replaced by the first as many of the next row.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("value"))
    dealt = _dealt(rows).repartition("bucket")
    dealt = dealt.withColumn("tree", tree(F.col("value")))
    follow = _follow(dealt, ["tree"])
    half = F.floor(F.length("value") / 2).cast("int")
    edited = F.concat(F.left("value", F.length("value") - half), F.left("next", half))
    made = follow.select("key", "value", "tree", "next_tree", edited.alias("edited")).withColumn("edited_tree", tree(F.col("edited")))
    near_edited = let(leaves(F.col("tree")), lambda a: let(leaves(F.col("edited_tree")), lambda b: likeness(a, b)))
    near_next = let(leaves(F.col("tree")), lambda a: let(leaves(F.col("next_tree")), lambda b: likeness(a, b)))
    same = lambda other, near: F.when(F.col("tree.root") == F.col(f"{other}.root"), F.lit(1.0)).otherwise(near)
    return made.select(
        F.col("key").alias(key), "value", "tree", "edited", "edited_tree", same("edited_tree", near_edited).alias("near_edited"), same("next_tree", near_next).alias("near_next")
    )
