"""URL filters: rules by host and path, and boosted trees on lexical features for URLs without a rule.

The trees are fitted on the driver on a bounded sample of labelled URLs (``SAMPLE`` rows, drawn by hash) and become
one SQL expression, so that every URL is judged by Spark without Python. Labels are a column of verdicts; where a
row has none, the verdict of its rule is the label.

Null URLs and URLs without ``://`` have empty host and path, fit no rule and are judged by the trees. Without
labelled rows every other URL is allowed. Rows that repeat are judged alike; input columns stay in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boost
from .common import let, packed

ALLOW, BLOCK = "allow", "block"
#: Labelled rows used for fitting, about (drawn by hash).
SAMPLE = 20_000
#: Rules are compiled into one expression; a longer list belongs into a table and a join.
MOST_RULES = 2_000


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is a host and the beginning of a path, like ``example.org/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0].lower()

    @property
    def path(self) -> str:
        _, slash, rest = self.pattern.partition("/")
        return slash + rest


def _lower(x: Column) -> Column:
    """A-Z only."""
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    host = _lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def matching_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The longest rule that fits as (size, pattern, verdict); null where none does. Ties: the last in text order."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} are compiled")
    fits = [
        F.when(
            ((host == F.lit(r.host)) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.pattern)).alias("size"), F.lit(r.pattern).alias("pattern"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    if not fits:
        return F.lit(None).cast("struct<size:int,pattern:string,verdict:string>")
    return F.array_max(F.array_compact(F.array(*fits)))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL, as doubles."""
    chars = F.split(url, "")
    entropy = let(
        F.filter(chars, lambda c: c != ""),
        lambda cs: F.aggregate(
            F.array_distinct(cs),
            F.lit(0.0),
            lambda total, c: total
            - let(
                F.size(F.filter(cs, lambda d: d == c)) / F.size(cs),
                lambda p: p * F.log2(p),
            ),
        ),
    )
    n = F.greatest(F.length(url), F.lit(1))
    out = {
        "f_length": F.length(url),
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_labels": F.size(F.split(host, r"\.")),
        "f_longest_label": F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / n,
        "f_host_digits": F.regexp_count(host, F.lit("[0-9]")),
        "f_hyphens": F.regexp_count(host, F.lit("-")),
        "f_entropy": entropy,
        "f_params": F.regexp_count(url, F.lit(r"[?&][^=&#]+=")),
        "f_escapes": F.regexp_count(url, F.lit("%[0-9A-Fa-f]{2}")),
        "f_fragment": F.contains(url, F.lit("#")).cast("int"),
        "f_secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    return {k: v.cast("double") for k, v in out.items()}


@dataclass(frozen=True)
class UrlModel:
    trees: boost.Trees
    suffixes: dict[str, tuple[float, float]]  # last host label -> share blocked, log of rows
    names: list[str]

    def log_odds(self) -> Column:
        """Of being blocked, over the columns of ``_with_features``."""
        return F.expr(self.trees.sql(self.names))


SUFFIX = ["f_suffix_blocked", "f_suffix_rows"]


def _with_suffix(df: DataFrame, suffixes: dict[str, tuple[float, float]]) -> DataFrame:
    blocked, rows = F.lit(0.5), F.lit(0.0)
    for name, (share, count) in sorted(suffixes.items()):
        blocked = F.when(F.col("suffix") == name, F.lit(share)).otherwise(blocked)
        rows = F.when(F.col("suffix") == name, F.lit(count)).otherwise(rows)
    return df.withColumn(SUFFIX[0], blocked).withColumn(SUFFIX[1], rows)


def _prepared(urls: DataFrame, url: str, rules: list[UrlRule], label: str | None) -> DataFrame:
    whole = F.coalesce(F.col("row")[url], F.lit(""))
    given = F.col("row")[label] if label else F.lit(None).cast("string")
    host, path = host_and_path(F.col("url"))
    return (
        packed(urls)
        .select("row", whole.alias("url"), given.alias("given"))
        .select("*", host.alias("host"), path.alias("path"))
        .select("*", matching_rule(F.col("host"), F.col("path"), rules).alias("fit"))
        .select("row", "url", "given", "host", "path", F.col("fit.pattern").alias("rule"), F.col("fit.verdict").alias("by_rule"))
    )


def _with_features(df: DataFrame) -> DataFrame:
    f = features(F.col("url"), F.col("host"), F.col("path"))
    return df.select("*", F.substring_index("host", ".", -1).alias("suffix"), *[v.alias(k) for k, v in f.items()])


def fit(urls: DataFrame, rules: list[UrlRule], url: str = "url", label: str | None = None, sample: int = SAMPLE) -> UrlModel:
    """Trees from the labelled rows of ``urls``; ``sample`` bounds what reaches the driver."""
    labelled = _prepared(urls.select(*dict.fromkeys([url, *([label] if label else [])])), url, rules, label)
    labelled = labelled.select("url", "host", "path", F.coalesce("given", "by_rule").alias("label")).where(F.col("label").isin(ALLOW, BLOCK))
    count = labelled.count()
    if count > sample:
        part = max(1, int(1_000_000 * sample / count))
        labelled = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < part)
    got = _with_features(labelled).drop("url", "host", "path").limit(2 * sample).toPandas()
    names = [c for c in got.columns if c.startswith("f_")]
    y = (got["label"] == BLOCK).to_numpy(float)
    suffixes: dict[str, tuple[float, float]] = {}
    for name, rows in got.assign(y=y).groupby("suffix")["y"]:
        if len(rows) >= 20:  # at most 2 * sample / 20 suffixes
            suffixes[name] = ((float(rows.sum()) + 1.0) / (len(rows) + 2.0), float(np.log1p(len(rows))))
    extra = [[suffixes.get(s, (0.5, 0.0))[k] for s in got["suffix"]] for k in (0, 1)]
    x = np.column_stack([got[names].to_numpy(float), *extra]) if len(got) else np.zeros((0, len(names) + 2))
    return UrlModel(boost.fit(x, y, trees=24, depth=3), suffixes, names + SUFFIX)


def judge(urls: DataFrame, rules: list[UrlRule], model: UrlModel, url: str = "url") -> DataFrame:
    """``row``, ``host``, ``path``, ``rule`` (or null), ``log_odds`` of being blocked, and ``verdict`` of each row."""
    ready = _with_suffix(_with_features(_prepared(urls, url, rules, None)), model.suffixes)
    odds = ready.select("row", "host", "path", "rule", "by_rule", model.log_odds().alias("log_odds"))
    trees = F.when(F.col("log_odds") > 0, BLOCK).otherwise(ALLOW)
    return odds.select("row", "host", "path", "rule", "log_odds", F.coalesce("by_rule", trees).alias("verdict"))
