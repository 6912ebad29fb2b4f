"""Removal of byte strings that occur earlier, by a depth-limited radix sort of suffixes.

Only the first ``threshold`` bytes of a suffix matter: two windows (the first ``threshold`` bytes of two suffixes) that agree so far are a
repeat, whatever follows. Suffixes are therefore dealt by digits of several bytes, most significant first, to ``DEPTHS``
bytes; a group that holds one suffix alone is finished at once, and only the others are dealt by the next digit. Groups that are
left at full depth are exactly the repeated windows, and each has one first member.

Suffixes are dealt in runs. All windows of a text that have the same smallest gram (of ``DEPTHS[0]`` bytes, by hash, leftmost
if equal) are neighbours, and which gram that is depends on nothing but the window's bytes. A block is a stretch of such windows on
a grid that starts at the gram; the bytes that all windows of a block share are its core, those that any of them covers its hull:

1. Blocks as wide as possible; the core is the gram itself. One row stands for some 35 windows.
2. The blocks that are left are cut into narrower ones, so that the core grows to the next depth, and so on.
3. In blocks of one window, core and hull are the window.

In each pass, blocks with the hull of an earlier block repeat it as a whole and are done: all their windows occur earlier. Of the
first ones, those whose core no other hull shares are done too: their windows occur nowhere else. The rest goes on. The first
occurrence of a window always lies in the first block of its hull, so nothing is lost by letting the later ones go. Hulls and cores are compared
by their 128-bit and 64-bit digests; equal cores only cost a further pass.

Hot groups: a task resolves the repeats among its own blocks, sends one row for each hull, and for each core one row to the
core's group. The others, whose core it has seen twice, go to groups of their own hull. It also remembers what it sent of late
(``MEMORY`` hulls and cores), so that a line or a text that is copied very often is a row or two for each task, and otherwise one for
each batch at most. Nothing is left out: the memory only decides where a row is resolved.

Documents are ordered by key, null last, then by a hash of their text. Rows with equal key and text are one document and its copies:
the first stays, the others are removed as a whole where they have ``threshold`` bytes. Null texts are empty; shorter texts
have no window. Texts of any length are cut into pieces that overlap by a window. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_free

THRESHOLD = 100
#: Bytes that are compared in each pass; the last one is the threshold.
DEPTHS = (32, 85, 100)
#: Bytes of texts that are cut into blocks at once (less than 2 ** 24).
PIECE = 1 << 20
#: Hulls, and cores, that a task remembers; a power of two.
MEMORY = 1 << 18

KEY = ["none", "id", "hash"]
UNSURE, SHARED, KNOWN = 0, 1, 2

_DEALT = [("deal", pa.int64()), ("hull_1", pa.int64()), ("hull_2", pa.int64()), ("none", pa.bool_()), ("id", pa.int64()), ("hash", pa.int64())]
_DEALT += [("start", pa.int32()), ("n", pa.int32()), ("lead", pa.int32()), ("state", pa.int8()), ("hull", pa.binary())]
DEALT = pa.schema(_DEALT)
DEALT_SQL = "deal long, hull_1 long, hull_2 long, none boolean, id long, hash long, start int, n int, lead int, state byte, hull binary"

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)
_SHIFT = np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Hashes of all grams of a buffer: a polynomial in 64-bit arithmetic, by sums from the front."""

    def __init__(self, size: int):
        self.up, self.down = _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1)

    def __call__(self, data: np.ndarray, length: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        x = (sums[length:] - sums[:-length]) * self.down[: len(data) - length + 1]
        x ^= x >> _SHIFT
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> _SHIFT
        return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def runs(data: np.ndarray, valid: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``start``, ``n``, ``lead`` (from the start to the gram) and the gram's hash of each run of windows. ``valid``: where windows begin."""
    least = sliding_min((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), width)
    edge = np.flatnonzero((least[1:] != least[:-1]) | (valid[1:] != valid[:-1])) + 1
    start = np.concatenate(([0], edge))
    stop = np.concatenate((edge, [len(least)]))
    inside = valid[start]
    start, stop = start[inside], stop[inside]
    gram = (least[start] & _PLACE).astype(np.int64)
    return start, stop - start, gram - start, hashes[gram]


class Memory:
    """Of a task: places of the hulls, and the cores, that it has sent. Each has one slot, which the latest to need it takes."""

    def __init__(self, slots: int = MEMORY):
        self.mask = np.uint64(slots - 1)
        self.hull, self.place = np.zeros((slots, 2), np.uint64), [np.zeros(slots, kind) for kind in (bool, np.int64, np.int64, np.int64)]
        self.core, self.with_hull, self.shared = (np.zeros(slots, kind) for kind in (np.uint64, np.uint64, bool))

    def repeats(self, hull: np.ndarray, place: list[np.ndarray]) -> np.ndarray:
        """Which blocks have a remembered hull and come after it. The others are remembered."""
        slot = hull[:, 0] & self.mask
        same = (self.hull[slot] == hull).all(1)
        before, level = np.zeros(len(slot), bool), same
        for mine, theirs in zip(place, self.place):
            before |= level & (theirs[slot] < mine)
            level = level & (theirs[slot] == mine)
        keep = slot[~before]
        self.hull[keep] = hull[~before]
        for mine, theirs in zip(place, self.place):
            theirs[keep] = mine[~before]
        return before

    def groups(self, core: np.ndarray, hull: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the blocks that lead their core have a core known to be shared, and for which a shared one was sent before."""
        slot = core & self.mask
        same = self.core[slot] == core
        sent = same & self.shared[slot]
        shared = shared | sent | (same & (self.with_hull[slot] != hull))
        self.core[slot], self.with_hull[slot], self.shared[slot] = core, hull, shared
        return shared, sent


def deal(doc: np.ndarray, n: np.ndarray, core: np.ndarray, hull: np.ndarray, place: list[np.ndarray], memory: Memory) -> dict[str, np.ndarray]:
    """Resolves the blocks of a batch, in order of their ``place``: three columns of the document's key, and the start. ``hull``: two columns.

    Gives the blocks to send: ``at`` (which block), ``deal``, ``state``, and ``n`` (stretches of known repeats are joined).
    """
    start = place[3]
    order = np.argsort(hull[:, 0], kind="stable")
    known = np.zeros(len(doc), bool)
    known[order[1:]] = (hull[order[1:]] == hull[order[:-1]]).all(1)
    first = np.flatnonzero(~known)
    known[first] = memory.repeats(hull[first], [c[first] for c in place])
    first = np.flatnonzero(~known)
    by_core = first[np.lexsort((hull[first, 0], core[first]))]
    leads = np.concatenate(([True], core[by_core[1:]] != core[by_core[:-1]]))[: len(by_core)]
    group = np.cumsum(leads) - 1
    shared, sent = memory.groups(core[by_core][leads], hull[by_core, 0][leads], np.bincount(group) > 1)
    leads[leads] = ~sent
    again = np.flatnonzero(known)
    joined = np.zeros(len(again), bool)
    joined[1:] = (doc[again[1:]] == doc[again[:-1]]) & (start[again[1:]] == start[again[:-1]] + n[again[:-1]])
    heads = np.flatnonzero(~joined)
    sums = np.add.reduceat(n[again], heads) if len(heads) else n[:0]
    again = again[heads]
    return {
        "at": np.concatenate((by_core, again)),
        "deal": np.concatenate((np.where(leads, core[by_core], hull[by_core, 1]), hull[again, 0] + start[again].astype(np.uint64) * np.uint64(_BASE))),
        "state": np.concatenate((np.where(shared[group], SHARED, UNSURE), np.full(len(again), KNOWN))),
        "n": np.concatenate((n[by_core], sums)),
    }


def _digests(data: memoryview, spans: Iterator[tuple[int, int]]) -> np.ndarray:
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(data[a:b]) for a, b in spans]), np.uint64).reshape(-1, 2)


def _batch(sent: dict[str, np.ndarray], keys: list[np.ndarray], start: np.ndarray, lead: np.ndarray, hull: np.ndarray, hulls: list[bytes] | None) -> pa.RecordBatch:
    at, known = sent["at"], sent["state"] == KNOWN
    digest = np.where(known[:, None], np.uint64(0), hull[at]).view(np.int64)
    columns = [sent["deal"].view(np.int64), digest[:, 0], digest[:, 1], *[k[at] for k in keys], start[at], sent["n"], lead[at], sent["state"]]
    columns = [pa.array(c, f.type) for c, f in zip([np.ascontiguousarray(c).astype(f.type.to_pandas_dtype()) for c, f in zip(columns, DEALT)], DEALT)]
    columns.append(pa.nulls(len(at), pa.binary()) if hulls is None else pa.array([None if k else hulls[i] for i, k in zip(at.tolist(), known.tolist())], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, schema=DEALT)


def _first_pass(threshold: int, depth: int, piece: int):
    """Whole texts to blocks around their smallest grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, width, memory = Grams(piece + threshold), threshold - depth + 1, Memory()

        def blocks(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            """parts: (none, id, hash, first byte, bytes), no document twice at one place."""
            parts.sort(key=lambda p: p[:4])
            raw = b"".join([p[4] for p in parts])
            if len(raw) < threshold:
                return
            sizes = np.array([len(p[4]) for p in parts])
            offsets = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            data = np.frombuffer(raw, np.uint8)
            opened = np.zeros(len(raw) + 1, np.int32)
            np.add.at(opened, offsets, 1)
            np.add.at(opened, np.maximum(offsets, offsets + sizes - threshold + 1), -1)
            valid = np.cumsum(opened)[: len(raw) - threshold + 1] > 0
            start, n, lead, core = runs(data, valid, grams(data, depth), width)
            if len(start) == 0:
                return
            part = np.searchsorted(offsets, start, "right") - 1
            hull = _digests(memoryview(raw), zip(start.tolist(), (start + n + threshold - 1).tolist()))
            *keys, begins = (np.array([p[k] for p in parts])[part] for k in range(4))
            own = start - offsets[part] + begins
            sent = deal(part, n, core, hull, [*keys, own], memory)
            yield _batch(sent, keys, own, lead, hull, None)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(3)]
            waiting, held = {}, 0
            for row, text in enumerate(batch.column(3)):
                text, key = text.as_buffer(), tuple(c[row] for c in columns)
                for first in range(0, max(1, text.size - threshold + 1), piece - threshold + 1):
                    part = text.slice(first, min(piece, text.size - first)).to_pybytes()
                    if len(part) < threshold:
                        continue
                    if held + len(part) > piece:
                        yield from blocks(list(waiting.values()))
                        waiting, held = {}, 0
                    if (*key, first) not in waiting:
                        waiting[*key, first] = (*key, first, part)
                        held += len(part)
            yield from blocks(list(waiting.values()))

    return run


def _next_pass(threshold: int, depth: int):
    """Blocks that are left, with their hulls, to narrower blocks."""
    width = threshold - depth + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            rows = sorted(set(zip(*[c.to_pylist() for c in batch.columns])))  # key, start, n, lead, hull
            doc, start, n, lead, core, hulls, keys, documents = [], [], [], [], [], [], [], {}
            for none, key, digest, at, size, gram, hull in rows:
                number = documents.setdefault((none, key, digest), len(documents))
                low = 0
                while low < size:
                    away = gram - low  # from the first window of the block to the gram
                    count = min(size - low, away % width + 1)
                    block = away // width
                    same = gram - block * width  # the last window that the block can hold
                    own = hull[low : low + count + threshold - 1]
                    doc.append(number)
                    keys.append((none, key, digest))
                    start.append(at + low)
                    n.append(count)
                    lead.append(away)
                    core.append(xxhash.xxh3_64_intdigest(hull[same : same + depth], block))
                    hulls.append(own)
                    low += count
            if not rows:
                continue
            hull = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, hulls)), np.uint64).reshape(-1, 2)
            core = hull[:, 1] if width == 1 else np.array(core, np.uint64)
            start, n, lead = (np.array(x, np.int64) for x in (start, n, lead))
            keys = [np.array(k) for k in zip(*keys)]
            sent = deal(np.array(doc), n, core, hull, [*keys, start], memory)
            yield _batch(sent, keys, start, lead, hull, None if width == 1 else hulls)

    return run


def _settle(dealt: DataFrame, last: bool) -> DataFrame:
    """The blocks that occur earlier (``again``), and those that the next pass cuts."""
    order = [F.asc("none"), F.asc("id"), F.asc("hash"), F.asc("start")]
    # Rank, not number: the rows of one document and its copies are the same place.
    earlier = F.rank().over(Window.partitionBy("deal", "hull_1", "hull_2").orderBy(*order)) > 1
    again = (F.col("state") == KNOWN) | earlier
    if last:
        dealt = dealt.repartition("deal").select(*KEY, "start", "n", "lead", "hull", again.alias("again"), F.lit(False).alias("goes_on"))
        return dealt.where("again")
    group = Window.partitionBy("deal").orderBy("hull_1", "hull_2", *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    others = F.max(F.col("state") == SHARED).over(group) | (F.min("hull_1").over(group) != F.max("hull_1").over(group)) | (F.min("hull_2").over(group) != F.max("hull_2").over(group))
    settled = dealt.repartition("deal").select("*", others.alias("others")).select(*KEY, "start", "n", "lead", "hull", "others", again.alias("again"))
    goes_on = F.col("others") & ~F.col("again")
    return settled.select(*KEY, "start", "n", "lead", F.when(goes_on, F.col("hull")).alias("hull"), "again", goes_on.alias("goes_on")).where("again or goes_on")


def _fetch(threshold: int):
    """The hulls of a text's blocks."""
    fields = [(f.name, f.type) for f in DEALT if f.name in (*KEY, "start", "n", "lead", "hull")]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                none, key, digest = (part.column(k).to_pylist() for k in range(3))
                rows = []
                for k, text in enumerate(part.column(3)):
                    text = memoryview(text.as_buffer())
                    for block in part.column(4)[k].as_py():
                        at = block["start"]
                        rows.append((none[k], key[k], digest[k], at, block["n"], block["lead"], bytes(text[at : at + block["n"] + threshold - 1])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(F.col(key).isNull().alias("none"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.xxhash64(value).alias("hash"), value.alias("text"))


def repeats(docs: DataFrame, threshold: int = THRESHOLD, depths: tuple[int, ...] = DEPTHS, key: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """``none``, ``id``, ``hash`` (the document), ``start``, ``n``: stretches of windows that each occur earlier."""
    if list(depths) != sorted(set(depths)) or depths[-1] != threshold or depths[0] < 1 or len(depths) < 2:
        raise ValueError("depths must rise to the threshold")
    texts = _keyed(docs, key, text)
    dealt = texts.where(F.octet_length("text") >= threshold).mapInArrow(_first_pass(threshold, depths[0], piece), DEALT_SQL)
    settled = stage_free(_settle(dealt, last=False), "depth_0")
    again = settled.where("again").select(*KEY, "start", "n")
    blocks = settled.where("goes_on").groupBy(*KEY).agg(F.collect_set(F.struct("start", "n", "lead")).alias("blocks"))  # those of one text
    here = texts.join(blocks.hint("merge"), KEY).select(*KEY, "text", "blocks")
    open_blocks = here.mapInArrow(_fetch(threshold), "none boolean, id long, hash long, start int, n int, lead int, hull binary")
    for k, depth in enumerate(depths[1:], 1):
        dealt = open_blocks.mapInArrow(_next_pass(threshold, depth), DEALT_SQL)
        settled = stage_free(_settle(dealt, last=depth == threshold), f"depth_{k}")
        open_blocks = settled.where("goes_on").select(*KEY, "start", "n", "lead", "hull")
        again = again.unionAll(settled.where("again").select(*KEY, "start", "n"))
    return again


def covered(starts: np.ndarray, sizes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes under stretches of windows."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order].astype(np.int64), np.maximum.accumulate((starts + sizes)[order].astype(np.int64) + threshold - 1)
    opens = np.concatenate(([True], starts[1:] > stops[:-1]))
    return starts[opens], stops[np.concatenate((opens[1:], [True]))]


def _remove(threshold: int):
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("none", pa.bool_()), ("id", pa.int64()), ("copies", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, out = batch.slice(first, 256), []
                for text, stretches in zip(part.column(3), part.column(4)):
                    raw, spans = text.as_py(), []
                    kept, size = raw, len(raw)
                    if stretches.is_valid:
                        fields = stretches.values
                        low, high = covered(fields.field(0).to_numpy(), fields.field(1).to_numpy(), threshold)
                        spans = list(zip(low.tolist(), high.tolist()))
                        kept = b"".join([raw[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), size])])
                    out.append((size, size - len(kept), [{"start": a, "stop": b} for a, b in spans], kept))
                columns = [part.column(k) for k in range(3)] + [pa.array(c, schema.field(3 + k).type) for k, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, depths: tuple[int, ...] = DEPTHS, key: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``spans`` (start and stop of the removed runs) and ``kept`` (bytes) of each row.

    Removed is every byte under a string of ``threshold`` bytes that also starts earlier, judged on the input. ``docs`` is
    read three times and should be a table, or the same rows each time.
    """
    found = repeats(docs, threshold, depths, key, text, piece)
    stretches = found.groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("stretches"))  # those of one text
    texts = _keyed(docs, key, text).groupBy(*KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    joined = texts.join(stretches.hint("merge"), KEY, "left").select("none", "id", "copies", "text", "stretches")
    schema = "none boolean, id long, copies long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"
    made = joined.mapInArrow(_remove(threshold), schema).withColumn(key, F.when(~F.col("none"), F.col("id")))
    step = 10_000  # copies of one row are listed in stretches
    made = made.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(step).cast("long"))).alias("from"))
    made = made.select("*", F.explode(F.sequence("from", F.least(F.col("from") + step, F.col("copies")) - 1)).alias("copy"))
    gone = (F.col("copy") > 0) & (F.col("n_bytes") >= threshold)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return made.select(
        key,
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, all_of_it).otherwise(F.col("spans")).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
