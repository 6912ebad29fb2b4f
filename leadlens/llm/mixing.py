"""Mixing sources to target weights, with DataFrame operations only.

Temperature mixing: a source's weight is its share of tokens to the power ``a``, normalised. ``a`` is bisected so that the
entropy of the weights, or the most often that any source is repeated, meets its target; several bisection levels are
evaluated in one aggregation over the table of sources. Weights are realised by epochs: a source gives its documents in the
order of a hash, whole epochs first and a beginning of the order after them, until its quota of tokens is met. The
stream is cut into blocks of ``block_tokens``, each with every source at its weight, and each block is a permutation.

Null sources are one source of their own, null texts have no words. A source without words has no weight and its rows
aren't drawn. Rows that repeat (same key and text) are drawn alike and lie together. Extra columns stay in ``row``
(``mix_rows``). An empty table, or one without words, gives an empty mix.

A source may hold most rows: running sums go over hash slices of a source first, and then inside slices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .common import WORD, packed

#: Levels of bisection in one aggregation, and aggregations.
LEVELS, PASSES = 5, 6
#: Rows of one hash slice of a source, about.
SLICE_ROWS = 2048


@dataclass(frozen=True)
class Mix:
    """Targets of a mix.

    ``entropy``: share of the largest possible entropy that the weights reach at least. ``most_epochs``: how often a
    source's documents are drawn at most, with ``tokens`` drawn in all; without ``tokens`` the budget is the least that draws
    every document once. With both targets the larger exponent (nearer to the natural shares) holds.
    """

    entropy: float | None = None
    most_epochs: float | None = None
    tokens: int | None = None
    block_tokens: int = 262_144
    seed: int = 0


def _rows(docs: DataFrame, mix: Mix, source: str, key: str, text: str) -> DataFrame:
    """``row``, ``key``, ``source``, ``n`` (words) and ``at`` (place in the source's order)."""
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    return packed(docs).select(
        "row",
        F.col("row")[key].alias("key"),
        F.col("row")[source].cast("string").alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("n"),
        F.xxhash64(F.lit(mix.seed), F.col("row")[key], whole).alias("at"),
    )


def source_table(rows: DataFrame) -> DataFrame:
    """``source``, ``docs``, ``tokens`` of each source with words."""
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")).where("tokens > 0")


def _spread(sources: DataFrame, exponents: list[float], mix: Mix, totals: dict) -> list[tuple[float, float]]:
    """For each exponent: entropy of the weights over the largest possible, and the most epochs of a source."""
    share = F.col("tokens") / F.lit(float(totals["tokens"]))
    cells = []
    for k, a in enumerate(exponents):
        power = F.pow(share, F.lit(a))
        cells += [F.sum(power).alias(f"z{k}"), F.sum(power * F.lit(a) * F.log(share)).alias(f"l{k}"), F.max(power / share).alias(f"m{k}"), F.min(power / share).alias(f"s{k}")]
    got = sources.agg(*cells).first()
    out = []
    for k in range(len(exponents)):
        z, most = got[f"z{k}"], max(totals["sources"], 1)
        import math

        entropy = (math.log(z) - got[f"l{k}"] / z) / math.log(most) if most > 1 else 1.0
        # Epochs of a source: budget * weight / tokens; the default budget gives the least repeated source one epoch.
        per_share = (mix.tokens / totals["tokens"]) / z if mix.tokens else 1.0 / got[f"s{k}"]
        out.append((entropy, per_share * got[f"m{k}"]))
    return out


def exponent(sources: DataFrame, mix: Mix, totals: dict) -> float:
    """The smallest exponent in [0, 1] that keeps the repetition limit, or the largest that reaches the entropy.

    Entropy falls and repetition falls as the exponent rises. Where a target can't be met, the nearer end holds.
    """
    if mix.entropy is None and mix.most_epochs is None:
        return 1.0

    def search(good_above: bool, good) -> float:
        low, high = 0.0, 1.0
        ends = _spread(sources, [low, high], mix, totals)
        if good_above and good(ends[0]):
            return low
        if good_above and not good(ends[1]):
            return high
        if not good_above and good(ends[1]):
            return high
        if not good_above and not good(ends[0]):
            return low
        for _ in range(PASSES):
            inner = 2**LEVELS
            tried = [low + (high - low) * j / inner for j in range(1, inner)]
            kept = [good(x) for x in _spread(sources, tried, mix, totals)]
            first, last = 0, inner  # bisection among the points that were evaluated together
            while last - first > 1:
                middle = (first + last) // 2
                if kept[middle - 1] == good_above:
                    last = middle
                else:
                    first = middle
            low, high = low + (high - low) * first / inner, low + (high - low) * last / inner
        return high if good_above else low

    found = []
    if mix.entropy is not None:
        found.append(search(False, lambda x: x[0] >= mix.entropy))
    if mix.most_epochs is not None:
        found.append(search(True, lambda x: x[1] <= mix.most_epochs * (1 + 1e-12)))
    return max(found)


def weights(sources: DataFrame, mix: Mix) -> DataFrame:
    """``source``, ``docs``, ``tokens``, ``weight`` and ``quota`` (tokens to draw, as a double) of each source."""
    first = sources.agg(F.count(F.lit(1)).alias("sources"), F.sum("tokens").alias("tokens")).first()
    totals = {"sources": first["sources"], "tokens": first["tokens"] or 1}
    a = exponent(sources, mix, totals) if totals["sources"] else 1.0
    power = F.pow(F.col("tokens") / F.lit(float(totals["tokens"])), F.lit(a))
    z, least = sources.agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    z, least = z or 1.0, least or 1.0
    budget = float(mix.tokens) if mix.tokens else z / least
    # Rounding: an epoch that is whole up to 1e-9 is whole.
    quota = F.lit(budget) * power / F.lit(z)
    whole = F.round(quota / F.col("tokens")) * F.col("tokens")
    quota = F.when(F.abs(quota - whole) <= 1e-9 * whole, whole).otherwise(quota)
    return sources.select("*", F.lit(a).alias("exponent"), (power / F.lit(z)).alias("weight"), quota.alias("quota"))


def _slices(table: DataFrame) -> Column:
    """The number of hash slices of a source, a power of two, and the slice of a hash."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / SLICE_ROWS))).cast("int")


def _slice_of(at: Column, bits: Column) -> Column:
    # Hashes in signed order are slices in order: the topmost bits, with the sign turned.
    return F.expr("shiftrightunsigned(at ^ -9223372036854775808, 64 - least(greatest(bits, 1), 62)) * if(bits = 0, 0, 1)").cast("long")


def _sliced(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` (source, n, at, ...) with the weights of their source and their hash slice of it."""
    drawn = rows.alias("rows").join(table.withColumn("bits", _slices(table)).alias("table"), F.col("rows.source").eqNullSafe(F.col("table.source")))
    drawn = drawn.select("rows.*", "table.tokens", "table.quota", "table.weight", "bits")
    return drawn.withColumn("slice", _slice_of(F.col("at"), F.col("bits"))).drop("bits")


def _streams(rows: DataFrame, table: DataFrame, narrow: DataFrame | None = None, order: str = "at") -> DataFrame:
    """``rows`` (source, n, at, ...) with the weights of their source and ``start``, their tokens' place in an epoch.

    ``narrow``: the same rows, for the sums of slices; sources are not null then, so that the join needs no exchange beside the
    window's. ``order`` begins with ``at``.
    """
    drawn = _sliced(rows, table)
    sums = (drawn if narrow is None else _sliced(narrow, table)).groupBy("source", "slice").agg(F.sum("n").alias("own"))
    before = sums.select("source", "slice", F.expr("sum(own) over (partition by source order by slice) - own").alias("before"))
    inside = drawn.withColumn(
        # Ties (equal rows) are told apart by nothing but ``order``, else they keep any order.
        "inside", F.expr(f"sum(n) over (partition by source, slice order by {order} rows between unbounded preceding and current row) - n")
    )
    joined = inside.alias("i").join(before.alias("b"), F.expr(f"i.source {'<=>' if narrow is None else '='} b.source and i.slice = b.slice"))
    return joined.select("i.*", (F.col("inside") + F.col("before")).alias("start")).drop("inside", "slice")


def _drawn(placed: DataFrame, mix: Mix) -> DataFrame:
    """``placed`` once for each epoch drawn, with ``epoch``, ``block`` and ``mixed``, whose order is that in a block."""
    # Epoch e of a document starts at e * tokens + start of its source's stream, and is drawn while that is within the quota.
    epochs = F.greatest(F.ceil((F.col("quota") - F.col("start")) / F.col("tokens")), F.lit(0)).cast("int")
    drawn = placed.withColumn("epoch", F.explode(F.when(epochs > 0, F.sequence(F.lit(0), epochs - 1)).otherwise(F.array().cast("array<int>"))))
    place = F.col("epoch") * F.col("tokens") + F.col("start")
    drawn = drawn.withColumn("block", F.floor(place / (F.col("weight") * mix.block_tokens)).cast("long"))
    return drawn.withColumn("mixed", F.xxhash64(F.lit(mix.seed), "block", "epoch", "at"))


def mix_plan(docs: DataFrame, mix: Mix, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and epoch drawn: ``key``, ``source``, ``weight``, ``epoch``, ``block``, ``position``, ``n_words``.

    Blocks and positions in a block give the order of the mix.
    """
    rows = stage(_rows(docs, mix, source, key, text).select("key", "source", "n", "at"), "rows")
    table = stage(weights(stage(source_table(rows), "sources"), mix), "weights")
    mixed = _drawn(_streams(rows, table), mix)
    return mixed.withColumn("position", F.expr("cast(row_number() over (partition by block order by mixed, key) - 1 as long)")).select(
        F.col("key").alias(key), F.col("source").alias(source), "weight", "epoch", "block", "position", F.col("n").alias("n_words")
    )


def _hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def mix_rows(docs: DataFrame, mix: Mix, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, in the order of ``mix_plan``: by block, and by position in it.

    Partitions are ranges of that order, and rows are sorted in them; whole rows are dealt out twice, by slice of a source and by
    range. Rows of equal key and text are told apart by a hash of their other columns, so that a retried task places them alike.
    """
    other = [F.col(f"row.`{f.name}`") for f in docs.schema.fields if _hashable(f.dataType)]
    rows = _rows(docs, mix, source, key, text).withColumn("tie", F.xxhash64(*other))
    rows = rows.withColumn("source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    narrow = stage(rows.select("source", "n", "at"), "rows")
    table = stage(weights(stage(source_table(narrow), "sources"), mix), "weights")
    drawn = _drawn(_streams(rows, table, narrow, "at, tie"), mix).select("row", "key", "tie", "block", "mixed")
    return drawn.repartitionByRange("block", "mixed").sortWithinPartitions("block", "mixed", "key", "tie").select("row.*")
