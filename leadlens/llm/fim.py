"""Fill-in-the-middle: whole texts cut at line ends into prefix, middle and suffix, and put in a new order.

One ``fullmatch`` of the repeated unit keeps every repetition of its capture, so ``ends(1)`` gives the number of units and
both cut offsets at once. The repetition is possessive: nothing is kept for backtracking, and a text of a million lines costs the
list of its line ends. The draws are the first four 8-digit groups of SHA-256 over seed and key. Only three
numbers a row come back from Python; the pieces are taken, joined and rebuilt by Spark's own string functions.

Null texts are empty, and empty texts stay plain. A null key is drawn like an empty one. Rows that repeat are cut alike, and all
stay. Texts that hold a marker stay plain, so ``restore`` is exact. The columns of the input are in ``row`` and never clash.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed

UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
SEED = 7


def cut(matcher: regex.Pattern, text: str, first: int, second: int) -> tuple[int, int, int]:
    """The number of units, and the code points before the lower and the higher of the two drawn cuts."""
    ends = [0, *matcher.fullmatch(text).ends(1)]
    low, high = sorted((first % len(ends), second % len(ends)))
    return len(ends) - 1, ends[low], ends[high]


def _cuts(unit: str):
    @F.pandas_udf("units long, low long, high long")
    def of(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        matcher = regex.compile(f"({unit})*+")
        return pd.DataFrame([cut(matcher, *row) for row in zip(texts, first, second)], columns=["units", "low", "high"])

    return of


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 100, spm_percent: int = 50, seed: int = SEED, unit: str = UNIT) -> DataFrame:
    """``row``, ``units``, ``form`` (plain, psm or spm), ``prefix``, ``middle``, ``suffix`` (null if plain) and ``output``.

    ``percent`` of the texts are cut, ``spm_percent`` of those with the suffix first. ``unit`` must match every text when
    repeated, and never the empty string.
    """
    value = F.coalesce(F.col("row")[text], F.lit(""))
    h = draws(F.col("row")[key], seed)
    cuts = packed(docs).select("row", value.alias("value"), _cuts(unit)(value, h[0], h[1]).alias("cuts"), h[2].alias("whether"), h[3].alias("which"))
    marked = F.lit(False)
    for marker in MARKERS:
        marked = marked | F.contains("value", F.lit(marker))
    plain = (F.col("value") == "") | marked | (F.col("whether") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("which") % 100 < spm_percent, "spm").otherwise("psm")

    def piece(start: Column, stop: Column | None) -> Column:
        length = F.length("value") if stop is None else stop - start
        return F.when(F.col("form") != "plain", F.substring(F.col("value"), (start + 1).cast("int"), length.cast("int")))

    low, high = F.col("cuts.low"), F.col("cuts.high")
    cut_up = cuts.select("row", "value", "cuts", form.alias("form")).select(
        "row",
        "value",
        F.col("cuts.units").alias("units"),
        "form",
        piece(F.lit(0), low).alias("prefix"),
        piece(low, high).alias("middle"),
        piece(high, None).alias("suffix"),
    )
    p, m, s = (F.concat(F.lit(mark), F.col(name)) for mark, name in zip((PREFIX, MIDDLE, SUFFIX), ("prefix", "middle", "suffix")))
    output = F.when(F.col("form") == "psm", F.concat(p, s, m)).when(F.col("form") == "spm", F.concat(s, p, m)).otherwise(F.col("value"))
    return cut_up.select("row", "units", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(form: Column, output: Column) -> Column:
    """The text from its form and output alone. No marker can begin inside a piece, since none overlaps itself or another."""

    def between(left: str, right: str) -> Column:
        inner = F.substring_index(output, right, 1)
        return F.substring(inner, F.length(F.substring_index(inner, left, 1)) + len(left) + 1, F.length(inner))

    def behind(left: str) -> Column:
        return F.substring(output, F.length(F.substring_index(output, left, 1)) + len(left) + 1, F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), behind(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), behind(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
