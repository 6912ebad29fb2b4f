"""Ranked lexical search: exact inner products over ball trees of sparse document vectors.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z change case. A document's component for a term
with tf occurrences is ``(10^9 * tf) div (1000 * tf + 8 * m)``, m its length against the average; an item's is its term's
weight times its repeats. The score is their inner product in 64-bit integers.

How it runs: items are taken in blocks (``BLOCK_ITEMS`` items, ``BLOCK_TERMS`` terms; an item with more is a block of its
own), so what travels with a function is bounded. Tasks count the block's terms in all documents, whole texts, and write one sparse row a
document. N, L and the document frequencies are aggregations of that table. Each task then builds a ball tree over as many of its rows as
``CHUNK`` allows, and searches it for each item, best bound first: no document of a ball has a higher product than

    item . centroid + |item| * radius

and none has a higher one than the same with a radius for each component, item . (centroid + radii), which is the item's product
with the highest components of the ball, an exact integer; the lower bound of the two counts. Radius and bound are rounded up by more than
the error of their floating-point sums, so no ball is left out that could hold a result; balls whose bound equals the last rank's score are opened, because a tie may rank higher. Leaves are
scored exactly in integers. The scores kept from one tree bound the next one. Each task returns ``k`` rows an item at most,
and one window ranks them.

Null texts have no term and match nothing; null keys rank last among equal scores. Rows that repeat are ranked each; so are items
that repeat. Without documents or items there are no rows. Long texts are split into slices at term ends. Extra columns are not carried.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

K = 10
BLOCK_ITEMS = 256
BLOCK_TERMS = 20_000
#: Documents of a tree, and of a leaf.
CHUNK = 8192
LEAF = 32
#: Centroid components of a tree.
CENTROIDS = 4_000_000
#: Bytes of a text that are split into terms at once.
SLICE = 1 << 22

#: Separators become a space, A-Z lower case; bytes beyond ASCII stay.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def term_counts(text: bytes) -> tuple[int, Counter]:
    """The number of terms of a UTF-8 text, and the occurrences of each."""
    counts, at = Counter(), 0
    clean = text.translate(_TERM_BYTES)
    while at < len(clean):
        stop = at + SLICE
        if stop < len(clean):
            cut = clean.rfind(b" ", at, stop)
            stop = cut if cut > at else clean.find(b" ", stop)
        part = clean[at:] if stop < 0 or stop >= len(clean) else clean[at:stop]
        counts.update(part.split())
        at += max(len(part), 1)
    return counts.total(), counts


def component(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def length_factor(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    if 75 * int(n.max(initial=0)) * documents >= 1 << 63:  # beyond 64 bits: exact all the same
        return np.array([25 + 75 * int(x) * documents // terms for x in n], np.int64)
    return 25 + 75 * n * documents // terms


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Rows:
    """Sparse rows: ``starts`` (one more than rows), ``terms`` and integer ``values``."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, order: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[order]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        places = np.repeat(self.starts[order] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(starts, self.terms[places], self.values[places])

    def slice(self, low: int, high: int) -> Rows:
        a, b = self.starts[low], self.starts[high]
        return Rows(self.starts[low : high + 1] - a, self.terms[a:b], self.values[a:b])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Row sums; each row has a component or more."""
        return np.add.reduceat(self.values * dense[self.terms], self.starts[:-1])

    def dense(self, row: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        a, b = self.starts[row], self.starts[row + 1]
        out[self.terms[a:b]] = self.values[a:b]
        return out


class BallTree:
    """A tree over rows with a component or more; ``order`` has the places of the rows as its leaves hold them."""

    def __init__(self, rows: Rows, width: int, leaf: int = LEAF):
        order = np.arange(len(rows.starts) - 1)
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centroids, radii, tops = [], [], []
        error = (width + 16) * 2.3e-16  # of a sum of so many products, each part relative to its length
        squares = np.add.reduceat(rows.values.astype(float) ** 2, rows.starts[:-1])

        def build(low: int, high: int) -> int:
            nonlocal rows, squares
            node, part, lengths = len(self.spans), rows.slice(low, high), squares[low:high]
            self.spans.append((low, high))
            self.children.append(None)
            centre = np.bincount(part.terms, part.values, width) / (high - low)
            square = float(centre @ centre)
            apart = lengths - 2 * part.dot(centre) + square
            slack = error * (np.sqrt(lengths) + math.sqrt(square)) ** 2
            top = np.zeros(width, np.int32)  # a component is at most 10^6
            np.maximum.at(top, part.terms, part.values.astype(np.int32))
            tops.append(top)
            centroids.append(centre)
            radii.append(math.sqrt(float((np.maximum(apart, 0) + 2 * slack).max())) * (1 + 1e-12))
            if high - low > leaf and (apart > 4 * slack).any():
                one = part.dense(int(apart.argmax()), width)
                away = lengths - 2 * part.dot(one)
                other = part.dense(int(away.argmax()), width)
                sides = np.argsort(part.dot(one - other), kind="stable")
                middle = low + (high - low) // 2
                moved = part.take(sides)
                a, b = rows.starts[low], rows.starts[high]
                rows.terms[a:b], rows.values[a:b] = moved.terms, moved.values
                rows.starts[low : high + 1] = moved.starts + a
                order[low:high] = order[low:high][sides]
                squares[low:high] = lengths[sides]
                self.children[node] = (build(low, middle), build(middle, high))
            return node

        rows = Rows(rows.starts.copy(), rows.terms.copy(), rows.values.copy())
        build(0, len(order))
        self.rows, self.order, self.width = rows, order, width
        self.centroids, self.radii, self.tops = np.array(centroids), np.array(radii), np.array(tops)

    def search(self, terms: np.ndarray, values: np.ndarray, best: Best) -> int:
        """Offers the documents with the highest inner products to ``best``; returns the number of leaves it opened."""
        norm = math.sqrt(float((values.astype(float) ** 2).sum()))
        ball = self.centroids[:, terms] @ values.astype(float) + norm * self.radii
        by_component = (self.tops[:, terms].astype(np.int64) * values).sum(1).astype(float)
        bounds = (np.minimum(ball, by_component) * (1 + 1e-9) + 1).tolist()
        item = np.zeros(self.width, np.int64)
        item[terms] = values
        queue, opened = [(-bounds[0], 0)], 0
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < best.least:
                break  # so are all that wait
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (max(bound, -bounds[child]), child))
                continue
            opened += 1
            low, high = self.spans[node]
            best.offer(self.rows.slice(low, high).dot(item), self.order[low:high])
        return opened


class Best:
    """The ``k`` best (score, key) so far: highest score, then smallest key, null last."""

    def __init__(self, k: int):
        self.k, self.kept, self.least = k, [], 1
        self.keys: list = []

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        near = np.flatnonzero(scores >= self.least)
        if len(near) == 0:
            return
        found = [(-s, self.keys[p] is None, self.keys[p] or 0) for s, p in zip(scores[near].tolist(), places[near].tolist())]
        self.kept = heapq.nsmallest(self.k, self.kept + found)
        if len(self.kept) == self.k:
            self.least = -self.kept[-1][0]

    def rows(self) -> list[tuple[int | None, int]]:
        return [(None if none else key, -score) for score, none, key in self.kept]


@dataclass
class Block:
    """Items that are searched together. ``items``: (number, id, {place of a term: repeats}); the number tells equal ids apart."""

    items: list[tuple[int, int | None, dict[int, int]]]
    vocabulary: dict[bytes, int]


def blocks(items: Iterator[tuple[int | None, str | None]], most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    now = Block([], {})
    for number, (item, text) in enumerate(items):
        counts = term_counts((text or "").encode())[1]
        if not counts:
            continue
        if now.items and (len(now.items) == most_items or len(now.vocabulary.keys() | counts.keys()) > most_terms):
            yield now
            now = Block([], {})
        now.items.append((number, item, {now.vocabulary.setdefault(t, len(now.vocabulary)): c for t, c in counts.items()}))
    if now.items:
        yield now


def _count(vocabulary: dict[bytes, int]):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part, sizes, terms, tfs, offsets = batch.slice(first, 512), [], [], [], [0]
                for text in part.column(1):
                    n, counts = term_counts(text.as_buffer().to_pybytes() if text.is_valid else b"")
                    found = sorted((vocabulary[t], c) for t, c in counts.items() if t in vocabulary)
                    sizes.append(n)
                    terms += [t for t, _ in found]
                    tfs += [c for _, c in found]
                    offsets.append(len(terms))
                at = pa.array(offsets, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((terms, pa.int32()), (tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), *lists], schema=schema)

    return run


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], width: int, documents: int, terms: int, k: int, chunk: int):
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def numpy(column: pa.Array) -> np.ndarray:
        return column.to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(k) for number, _, _ in items}
        waiting, held = [], 0

        def work() -> None:
            nonlocal waiting, held
            joined = pa.Table.from_batches(waiting).combine_chunks()
            waiting, held = [], 0
            batch = joined.to_batches()[0]
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            tf = numpy(batch.column("tfs").flatten())
            m = np.repeat(length_factor(numpy(batch.column("n")), documents, terms), sizes)
            starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            tree = BallTree(Rows(starts, numpy(batch.column("terms").flatten()), component(tf, m)), width)
            keys = batch.column("doc_id").to_pylist()
            for number, at, values in items:
                best[number].keys = keys
                tree.search(at, values, best[number])

        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
            for first in range(0, batch.num_rows, chunk):
                part = batch.slice(first, chunk)
                if held and held + part.num_rows > chunk:
                    work()
                waiting.append(part)
                held += part.num_rows
        if held:
            work()
        found = [(number, key, score) for number, b in best.items() for key, score in b.rows()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return run


def search_block(docs: DataFrame, block: Block, k: int = K) -> DataFrame:
    """``item`` (number), ``rank``, ``doc_id``, ``score`` for the items of a block. ``docs``: ``doc_id`` and the text as binary."""
    counted = docs.mapInArrow(_count(block.vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>")
    counted = stage(counted, "term_counts")
    documents, terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # As many rows as the block has terms, at most.
    df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    w = {t: weight(documents, df.get(t, 0)) for t in block.vocabulary.values()}
    items = []
    for number, _, repeats in block.items:
        places = sorted(t for t in repeats if w[t] > 0 and t in df)
        if places:
            items.append((number, np.array(places), np.array([w[t] * repeats[t] for t in places])))
    width = len(block.vocabulary)
    chunk = min(CHUNK, LEAF * max(1, CENTROIDS // (4 * width)))
    found = counted.mapInArrow(_search(items, width, documents, terms, k, chunk), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: for each item, its ``k`` documents with the highest scores above 0.

    Items come to the driver a block at a time, and each block reads the documents once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    stream = items.select(F.col(item_key).cast("long"), F.col(item_text)).toLocalIterator()
    out = None
    for block in blocks((r[0], r[1]) for r in stream):
        names = spark.createDataFrame([(number, item) for number, item, _ in block.items], "item long, item_id long")
        found = search_block(rows, block, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
