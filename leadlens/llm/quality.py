"""Quality rules: a threshold table compiled into one projection, without user functions.

Each rule is a row of ``RULES``: a measure, the smallest and the largest value that pass. The
measures are ratios of counts over the whole text, so that they do not depend on its length.
``judge`` adds the counts, the ratios, the names of the failed rules and ``kept`` to each row.

Nulls and texts without a word have zero counts and fail the length rule; rows that repeat are
judged alike and all stay; columns of the input never clash, because the result nests them in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, packed, words_of

# Frequent function words of the four languages of the corpus, of any length and in lower case.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this are at from or an not have "
    "der die und den von das ist des im ein eine auf für mit zu dem nicht sich auch als "
    "de la le et les en un une que est pour dans du des il au par qui sur ne pas "
    "el los y las del se por con una su al lo es no para como más o si"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    at_least: float | None = None
    at_most: float | None = None
    from_words: int = 0  # the rule holds for texts with so many words or more


#: The production table. ``length`` and ``repeats`` are the base rules.
RULES = (
    Rule("length", "n_words", at_least=50),
    Rule("repeats", "repeat_ratio", at_most=0.5),
    Rule("long_words", "mean_word_chars", at_least=1.5, at_most=20.0),
    Rule("symbols", "symbol_ratio", at_most=0.3),
    Rule("lines", "dup_line_ratio", at_most=0.5),
    Rule("stop_words", "stop_ratio", at_least=0.01),
)
BASE_RULES = ("length", "repeats")


#: Up to so many repeated hashes a window is looked up among them; beyond, every window is compared. Either way
#: the windows compared hold all that repeat, so that the count is the same.
LOOKED_UP = 12


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that the text has twice or more.

    Windows with equal words have equal hashes, so hashes that occur once are out. The other windows
    are sorted as text with their place appended: equal ones are neighbours then. The places of
    repeated ones are read in order, and overlaps are counted once.
    """

    def covered(places: Column) -> Column:
        gaps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def window(i: Column) -> Column:
        return F.concat_ws(" ", words[i], words[i + 1], words[i + 2], F.lpad(i.cast("string"), 10, "0"))

    def neighbours(a: Column, b: Column) -> Column:
        same = F.substr(a, F.lit(1), F.length(a) - 10) == F.substr(b, F.lit(1), F.length(b) - 10)
        both = F.array(F.right(a, F.lit(10)).cast("int"), F.right(b, F.lit(10)).cast("int"))
        return F.when((F.octet_length(a) == F.octet_length(b)) & same, both)

    def places(candidates: Column) -> Column:
        def repeated(s: Column) -> Column:
            pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), neighbours)
            return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

        return F.when(F.size(candidates) < 2, F.array().cast("array<int>")).otherwise(let(F.sort_array(F.transform(candidates, window)), repeated))

    def counted(hashes: Column) -> Column:
        def among(twice: Column) -> Column:
            everywhere = F.sequence(F.lit(0), F.size(hashes) - 1)
            return F.when(F.size(twice) == 0, F.lit(0)).otherwise(
                let(
                    F.when(
                        F.size(twice) <= LOOKED_UP,
                        F.filter(everywhere, lambda i: F.array_contains(twice, hashes[i])),
                    ).otherwise(everywhere),
                    lambda candidates: let(places(candidates), covered),
                )
            )

        def twice_in(s: Column) -> Column:
            same = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), lambda a, b: F.when(a == b, a))
            return F.array_distinct(F.array_compact(same))

        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(let(let(F.sort_array(hashes), twice_in), among))

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(hashes, counted))


def _counts(text: Column) -> Column:
    """The counts of one text as a struct."""

    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    return let(words_of(text), of)


def _measures(c: Column) -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(c[whole] > 0, c[part] / c[whole]).otherwise(F.lit(0.0))

    return {
        "n_words": c["n_words"].cast("double"),
        "repeat_ratio": share("n_repeat_words", "n_words"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "stop_ratio": share("n_stop_words", "n_words"),
    }


def compile_rules(rules: tuple[Rule, ...], measures: dict[str, Column]) -> Column:
    """The names of the rules that a row fails, as one array expression."""
    failed = []
    for rule in rules:
        x = measures[rule.measure]
        bad = F.lit(False)
        if rule.at_least is not None:
            bad = bad | (x < F.lit(float(rule.at_least)))
        if rule.at_most is not None:
            bad = bad | (x > F.lit(float(rule.at_most)))
        if rule.from_words:
            bad = bad & (measures["n_words"] >= F.lit(float(rule.from_words)))
        failed.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``row``, ``counts``, ``failed`` (names of failed rules) and ``kept`` of each row of ``docs``."""
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    counted = packed(docs).select("row", _counts(whole).alias("counts"))
    return counted.select("row", "counts", compile_rules(rules, _measures(F.col("counts"))).alias("failed")).select(
        "*", (F.size("failed") == 0).alias("kept")
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass every rule, with the columns of ``docs``.

    The condition is one expression that counts once: over the columns of ``judge`` the filter would be pushed below them, with
    the counts written out once for each rule.
    """
    passes = let(_counts(F.coalesce(F.col("row")[text], F.lit(""))), lambda counts: F.size(compile_rules(rules, _measures(counts))) == 0)
    return packed(docs).where(passes).select("row.*")
