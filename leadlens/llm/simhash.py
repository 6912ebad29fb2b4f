"""SimHash near-duplicates: fingerprints, a byte-position inverted index with count filtering, and components.

A fingerprint has eight bytes. Two that differ in at most ``d`` bits share at least ``8 - d`` positional bytes. The index
entries hold so many positional bytes together (for d = 2: 28 entries of six bytes for each fingerprint), because lists of a
single positional byte hold 1/256 of all fingerprints each and their pairs would grow with the square of the input. A list
of this index holds exactly those that reach the count, and at most 2 ** (8 * d) fingerprints, whatever the input. Within a
list, shared bytes are counted and the bits that differ are verified; a spanning set of the verified links is kept, so that a
dense group costs its size and not its square.

Null and empty texts, and texts without a word, have fingerprint zero and are linked like any other. Rows that repeat share a
fingerprint, hence a component. Null keys never become a component's id unless a component has no other.
Extra columns stay in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .common import packed, shuffle_width
from .components import components

BYTES = 8
SEED = 42
#: Shingles hashed at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a UTF-8 text: words split at ASCII white space, A-Z in lower case, shingles with repeats."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for first in range(0, total, CHUNK):
        part = words[first : first + CHUNK + shingle - 1]
        hashes = np.array([digest(join(s), SEED) for s in zip(*[part[k:] for k in range(shingle)])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``row`` and ``fp`` (the 64 bits as a signed long) of each row."""
    whole = F.coalesce(F.col("row")[text], F.lit("")).cast("binary")
    return packed(docs).select("row", _fingerprints(shingle)(whole).alias("fp"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _masks(positions: tuple[int, ...]) -> int:
    """The bits at these byte positions, as a signed long."""
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def index(fps: DataFrame, bits: int) -> DataFrame:
    """``list`` and its ``members`` for each list with two fingerprints or more. ``fps``: distinct ``fp``."""
    shared = BYTES - bits
    fps = fps.repartition(shuffle_width(fps.sparkSession), F.xxhash64("fp"))  # few bytes, of which adaptive execution would make a few tasks
    entries = F.array(
        *[
            F.struct(F.lit(k).cast("short").alias("at"), F.col("fp").bitwiseAND(F.lit(_masks(p)).cast("long")).alias("bytes"))
            for k, p in enumerate(combinations(range(BYTES), shared))
        ]
    )
    return (
        fps.select("fp", F.explode(entries).alias("entry"))
        .groupBy("entry")
        .agg(F.collect_list("fp").alias("members"))  # at most 2 ** (8 * bits)
        .where(F.size("members") > 1)
        .select("members")
    )


def _links(bits: int):
    """Spanning links of the verified pairs of each list."""
    shared = BYTES - bits

    def verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = a ^ b
        same_bytes = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
        near = same_bytes >= shared
        near[near] = np.bitwise_count(differ[near]) <= bits
        return near

    def spanning(members: np.ndarray) -> list[tuple[int, int]]:
        members = np.unique(members)
        n = len(members)
        root = np.arange(n)

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []

        def join(ia: np.ndarray, ib: np.ndarray) -> None:
            for i, j in zip(ia.tolist(), ib.tolist()):
                x, y = find(i), find(j)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((int(members[i].view(np.int64)), int(members[j].view(np.int64))))

        if n <= 64:
            ia, ib = np.triu_indices(n, 1)
            near = verified(members[ia], members[ib])
            join(ia[near], ib[near])
            return out
        # Look up each neighbour by value: work is the size of the list times the number of bit patterns.
        free = int(np.bitwise_or.reduce(members ^ members[0]))
        places = [k for k in range(64) if free >> k & 1]
        for count in range(1, bits + 1):
            for chosen in combinations(places, count):
                other = members ^ np.uint64(sum(1 << k for k in chosen))
                at = np.minimum(np.searchsorted(members, other), n - 1)
                hit = np.flatnonzero((members[at] == other) & (members < other))
                if len(hit):
                    hit = hit[verified(members[hit], other[hit])]
                    join(hit, at[hit])
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = [np.asarray(m, np.int64).view(np.uint64) for m in batch["members"]]
            twos = [m for m in lists if len(m) == 2]
            found = [p for m in lists if len(m) > 2 for p in spanning(m)]
            if twos:
                pair = np.array(twos)
                pair = pair[verified(pair[:, 0].copy(), pair[:, 1].copy())].view(np.int64)
                found += list(map(tuple, pair.tolist()))
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that connect all at ``bits`` differing bits or fewer."""
    if not 0 <= bits <= 3:
        raise ValueError("the lists are bounded for 0 to 3 differing bits")
    if bits == 0:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    return index(fps, bits).mapInPandas(_links(bits), "a long, b long").distinct()


def groups(prints: DataFrame, bits: int = 2) -> DataFrame:
    """``fp``, ``group`` for each fingerprint that has a neighbour; ``group`` is a fingerprint of the component."""
    return components(links(prints.select("fp").distinct(), bits)).select(F.col("node").alias("fp"), F.col("root").alias("group"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fp`` and ``component`` (the smallest key that links reach) of each row."""
    prints = fingerprints(docs, shingle, text).select(F.col(f"row.{key}").alias("key"), "fp")
    prints = stage(prints, "fingerprints")
    linked = stage(groups(prints, bits), "groups")
    lowest = prints.groupBy("fp").agg(F.min("key").alias("low")).join(linked, "fp", "left").select("fp", "low", F.coalesce("group", "fp").alias("group"))
    lowest = stage(lowest, "lowest")
    group_low = lowest.groupBy("group").agg(F.min("low").alias("component"))
    by_print = stage(lowest.join(group_low, "group").select("fp", "component"), "components")
    return prints.join(by_print, "fp").select(F.col("key").alias(key), "fp", "component")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``: that with the smallest key (null last, then any one)."""
    rows = fingerprints(docs, shingle, text).select("row", "fp", F.monotonically_increasing_id().alias("place"))
    rows = stage(rows, "rows")  # fixes the places
    prints = rows.select("fp", "place", F.col(f"row.{key}").alias("key"))
    linked = stage(groups(prints, bits), "groups")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "place")).alias("first")
    lowest = prints.groupBy("fp").agg(first).join(linked, "fp", "left")
    kept = lowest.groupBy(F.coalesce("group", "fp").alias("group")).agg(F.min("first").alias("first")).select("first.place")
    # One row a component: a share of the input, so it is never broadcast, also where it happens to be small.
    return rows.join(stage(kept, "kept").hint("merge"), "place", "left_semi").select("row.*")
