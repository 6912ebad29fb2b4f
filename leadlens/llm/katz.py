"""Language-model scores by Katz backoff: Good-Turing discounted counts, and backoff weights that normalise exactly.

The model is a bigram model over lower-cased words with one end token a text. With r the count of (h, w) and c(h) that of h:

    p(w | h) = d(r) * r / c(h)          where the training texts have (h, w)
             = alpha(h) * p(w)          else, alpha(h) = (1 - sum of the above) / (1 - sum of p(w) over those w)
    p(w)     = d(c) * c / N             where they have w; the rest is the probability of any unknown word

d is Katz's Good-Turing discount for counts up to ``K``; larger counts lose ``KEPT_BACK``, so that every history keeps some mass for
words that did not follow it. Histories that were not seen have alpha 1.

How it runs: unigram counts are one aggregation. Tasks then cut their documents into blocks and send, for each block and
partition of the bigram table, the block's distinct (h, w, text) with their counts, word lists written once. A partition holds all
occurrences of its predicted words, so it has r, c(w) and p(w) at hand. It returns to each block what it asked for, and adds
each history's discounted mass and unigram mass. The latter are summed to the backoff table, which is joined with the few
occurrences that backed off. Very frequent words are spread over partitions by their history; there are at most four for
each partition, and their counts travel with the functions.

Null and empty texts are the end token alone. Rows that repeat count each time; the result has one row for each, by its own number, so
null and repeated keys are no matter. Long texts are split over blocks as they come. Without training texts N and V are
0 and every word is unknown (p = 1). ``docs`` should be read from a table: blocks are what a task reads, and a retried
task must read the same. Extra columns are not carried.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import shuffle_width

END, BEGIN, HELD_OUT = b" ", b"", b"\n"  # no word is empty or white space
K = 5
KEPT_BACK = 0.05
#: Tokens of a block, about; a block ends after a text.
BLOCK_TOKENS = 2_000_000
DOCS_A_BLOCK = 1 << 22
#: Tokens of a partition of the bigram table, about; a task holds one at a time.
PART_TOKENS = 2_000_000


@dataclass(frozen=True)
class Discounts:
    """d(r) * r for r = 1 .. K, from counts of counts."""

    mass: tuple[float, ...]

    @staticmethod
    def of(n: list[int]) -> "Discounts":
        """``n``: how many have count 1, 2, ..., K + 1. Where Good-Turing gives no usable value, half a count is kept back."""
        out, n1 = [], n[0]
        tail = (K + 1) * n[K] / n1 if n1 else 1.0
        for r in range(1, K + 1):
            d = 0.0
            if n1 and n[r - 1] and tail < 1:
                d = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail)
            out.append(r * d if 0 < d < 1 else r - 0.5)
        return Discounts(tuple(out))

    def of_counts(self, r: np.ndarray) -> np.ndarray:
        """d(r) * r of counts; 0 for 0."""
        table = np.array([0.0, *self.mass])
        return np.where(r <= K, table[np.minimum(r, K)], r - KEPT_BACK)


@dataclass(frozen=True)
class Unigrams:
    """What every task needs of the unigram table."""

    tokens: int
    types: int
    discounts: Discounts
    unknown: float  # the probability of any unknown word
    frequent: dict[bytes, int]
    parts: int  # of the bigram table

    def log_p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, np.log10(np.maximum(self.discounts.of_counts(c), 1e-300) / max(self.tokens, 1)), math.log10(self.unknown))


def _words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.lower().split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, training, text) of each row, a few rows of a batch at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            yield from zip(*(c.to_pylist() for c in part.columns))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return made

    for _key, training, text in _texts(batches):
        words = _words(text)
        if training:
            counts.update(words)
            counts[END] += 1
        else:
            counts[HELD_OUT] += len(words) + 1
        if len(counts) > 1_000_000:
            yield out()
    yield out()


def unigram_table(docs: DataFrame) -> DataFrame:
    """``word`` (UTF-8 bytes), ``c`` in the training texts of ``docs`` (key, training, text); ``HELD_OUT`` has the tokens of the others."""
    return docs.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _classes(c: str) -> list[Column]:
    return [F.sum(F.when(F.col(c) == r, 1).otherwise(0)).alias(f"n{r}") for r in range(1, K + 2)]


def summarise(table: DataFrame, least_parts: int, part_tokens: int = PART_TOKENS) -> Unigrams:
    """What tasks need of the table. The bigram table gets so many partitions that one has ``part_tokens`` tokens of all texts, about."""
    unigrams = table.where(F.col("word") != F.lit(HELD_OUT))
    got = unigrams.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types"), F.sum(F.when(F.col("c") > K, F.col("c")).otherwise(0)).alias("rest"), *_classes("c")).first()
    n = [got[f"n{r}"] or 0 for r in range(1, K + 2)]
    discounts, tokens = Discounts.of(n), got["tokens"]
    every = tokens + (table.where(F.col("word") == F.lit(HELD_OUT)).agg(F.sum("c")).first()[0] or 0)
    parts = max(least_parts, -(-every // part_tokens))
    above = got["types"] - sum(n[:K])
    known = sum(m * k for m, k in zip(discounts.mass, n)) + (got["rest"] or 0) - KEPT_BACK * above
    frequent = unigrams.where(F.col("c") * (4 * parts) > tokens).collect() if tokens else []  # fewer than four a part
    return Unigrams(tokens, got["types"], discounts, 1 - known / tokens if tokens else 1.0, {bytes(r["word"]): r["c"] for r in frequent}, parts)


def _pack(value: tuple) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _narrow(x: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds it."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


class Places(dict):
    """Words to places, in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _part_of(words: list[bytes], parts: int) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(parts)).astype(np.int64)


def _send(parts: int, frequent: frozenset[bytes], block_tokens: int):
    """Blocks of documents as (part, block, payload) rows."""

    def of_block(block: int, keys: list, training: list[bool], lengths: list[int], ids: list[np.ndarray], voc: Places) -> Iterator[tuple]:
        held_out = ~np.array(training, bool)
        yield block % parts, block, _pack(("texts", keys, held_out, np.array(lengths, np.int64)))
        words = list(voc)
        token = np.concatenate(ids)
        text = np.repeat(np.arange(len(keys)), np.array(lengths))
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)] = voc[BEGIN]
        wide, texts = len(words), len(keys)
        if wide * wide * texts >= 1 << 63:
            raise OverflowError("a block holds too many words; lower block_tokens")
        key, times = np.unique((token * wide + before) * texts + text, return_counts=True)
        pair, text = key // texts, key % texts
        w, h = pair // wide, pair % wide
        home = _part_of(words, parts)
        spread = np.fromiter(map(frequent.__contains__, words), bool, wide)
        to = np.where(spread[w], (home[w] + home[h]) % parts, home[w])
        order = np.argsort(to, kind="stable")
        stops = np.searchsorted(to[order], np.arange(parts + 1))
        for part in range(parts):
            rows = order[stops[part] : stops[part + 1]]
            if len(rows):
                own_w, at_w = np.unique(w[rows], return_inverse=True)
                own_h, at_h = np.unique(h[rows], return_inverse=True)
                lists = [b"\n".join([words[i] for i in own.tolist()]) for own in (own_w, own_h)]
                in_text = text[rows]
                yield part, block, _pack(("counts", *lists, _narrow(at_w), _narrow(at_h), _narrow(in_text), _narrow(times[rows]), np.packbits(held_out[in_text])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def afresh() -> Places:
            return Places({BEGIN: 0, END: 1})

        task, number = TaskContext.get().partitionId(), 0
        keys, training, lengths, ids, voc, held = [], [], [], [], afresh(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for part, block, payload in of_block((task << 20) + number, keys, training, lengths, ids, voc):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([payload], pa.binary())], names=["part", "block", "payload"])

        for key, trains, text in _texts(batches):
            words = _words(text)
            words.append(END)
            ids.append(voc.of(words))
            keys.append(key), training.append(bool(trains)), lengths.append(len(words))
            held += len(words)
            if held >= block_tokens:
                yield from flush()
                number += 1
                keys, training, lengths, ids, voc, held = [], [], [], [], afresh(), 0
        if keys:
            yield from flush()

    return run


ANSWERS = "kind string, block long, payload binary, h binary, uid long, n long, big long, many long, p double, " + ", ".join(f"n{r} long" for r in range(1, K + 2))


def _answer(unigrams: Unigrams):
    """One partition of the bigram table: answers to blocks, masses of histories, occurrences that back off, counts of counts."""
    schema = pa.schema(
        [("kind", pa.string()), ("block", pa.int64()), ("payload", pa.binary()), ("h", pa.binary()), ("uid", pa.int64()), ("n", pa.int64()), ("big", pa.int64()), ("many", pa.int64()), ("p", pa.float64())]
        + [(f"n{r}", pa.int64()) for r in range(1, K + 2)]
    )

    def rows(kind: str, total: int, /, **columns) -> Iterator[pa.RecordBatch]:
        for first in range(0, total, 100_000):
            size = min(100_000, total - first)
            arrays = [
                pa.array([kind] * size, pa.string())
                if f.name == "kind"
                else pa.array(columns[f.name][first : first + size], f.type)
                if f.name in columns
                else pa.nulls(size, f.type)
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = Places()
        parts, sizes, ws, hs, trained = [], [], [], [], []
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                kind, *value = _unpack(payload)
                if kind == "texts":
                    yield from rows("texts", 1, block=[block], payload=[payload])
                    continue
                w_list, h_list, at_w, at_h, text, times, held_bits = value
                local = [voc.of(joined.split(b"\n")) for joined in (w_list, h_list)]
                held = np.unpackbits(held_bits, count=len(text)).astype(bool)
                ws.append(local[0][at_w]), hs.append(local[1][at_h])
                parts.append((block, text, times, held))
                sizes.append(len(text))
                trained.append(np.where(held, 0, times).astype(np.int64))
        if not parts:
            return
        words, wide = list(voc), len(voc)
        w, h, seen = np.concatenate(ws), np.concatenate(hs), np.concatenate(trained)
        c = np.bincount(w, seen, wide).astype(np.int64)
        for x, count in unigrams.frequent.items():
            if x in voc:
                c[voc[x]] = count
        ws.clear(), hs.clear(), trained.clear()
        pairs, place = np.unique(w * wide + h, return_inverse=True)
        r = np.bincount(place, seen, len(pairs)).astype(np.int64)
        log_p = unigrams.log_p(c)
        # masses of histories
        known = r > 0
        pair_r, pair_h, pair_w = r[known], pairs[known] % wide, pairs[known] // wide
        heads, at = np.unique(pair_h, return_inverse=True)
        if len(heads):
            big = pair_r > K
            columns = {f"n{k}": np.bincount(at[pair_r == k], minlength=len(heads)) for k in range(1, K + 1)}
            columns |= {
                "big": np.bincount(at[big], pair_r[big], len(heads)).astype(np.int64),
                "many": np.bincount(at[big], minlength=len(heads)),
                "p": np.bincount(at, 10.0 ** log_p[pair_w], len(heads)),
                "h": [words[i] for i in heads.tolist()],
            }
            yield from rows("history", len(heads), **columns)
        yield from rows("classes", 1, **{f"n{k}": [int((pair_r == k).sum())] for k in range(1, K + 2)})
        # answers
        stop = np.cumsum(sizes)
        for (block, text, times, held), first, last in zip(parts, stop - sizes, stop):
            own_r, own_w = r[place[first:last]], w[first:last]
            yield from rows("answer", 1, block=[block], payload=[_pack((text, times, _narrow(own_r), _narrow(c[own_w])))])
            missed = np.flatnonzero(own_r == 0)
            if len(missed):
                yield from rows(
                    "backoff", len(missed), h=[words[i] for i in h[first:last][missed].tolist()], uid=block * DOCS_A_BLOCK + text[missed].astype(np.int64), n=times[missed].astype(np.int64)
                )

    return run


def _finish(unigrams: Unigrams, bigrams: Discounts):
    """Scores of one block, but for the backoff weights."""
    schema = pa.schema([("uid", pa.int64()), ("key", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, texts, number = [], None, 0
        for batch in batches:
            for kind, block, payload in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                number = block
                if kind == "texts":
                    texts = _unpack(payload)
                else:
                    answers.append(payload)
        _, keys, held, lengths = texts
        n = len(keys)
        known, base, score = np.zeros(n), np.zeros(n), np.zeros(n)
        for payload in answers:
            text, times, r, c = _unpack(payload)
            text, times, r, c = text.astype(np.int64), times.astype(float), r.astype(np.int64), c.astype(np.int64)
            known += np.bincount(text, times * (c > 0), n)
            base += np.bincount(text, times * np.log10(c + 1.0), n)
            seen = np.log10(np.maximum(bigrams.of_counts(r), 1e-300))
            # Counts of histories: every token but the end is a history once, and the end has the count of the beginning.
            score += np.bincount(text, times * (np.where(r > 0, seen, unigrams.log_p(c)) - np.log10(np.maximum(c, 1))), n)
        base -= lengths * math.log10(unigrams.tokens + unigrams.types + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number * DOCS_A_BLOCK + np.arange(n)), pa.array(keys, pa.int64()), pa.array(held), pa.array(lengths), pa.array(np.rint(known).astype(np.int64)), pa.array(base), pa.array(score)], schema=schema
        )

    return run


def backoff_table(answers: DataFrame, bigrams: Discounts) -> DataFrame:
    """``h``, ``c`` and ``alpha`` of each history that the training texts have."""
    sums = answers.where("kind = 'history'").groupBy("h").agg(*[F.sum(x).alias(x) for x in ("big", "many", "p", *(f"n{r}" for r in range(1, K + 1)))])
    count, mass = F.col("big"), F.col("big") - F.lit(KEPT_BACK) * F.col("many")
    for r in range(1, K + 1):
        count = count + F.lit(r) * F.col(f"n{r}")
        mass = mass + F.lit(bigrams.mass[r - 1]) * F.col(f"n{r}")
    return sums.select("h", count.alias("c"), ((1 - mass / count) / (1 - F.col("p"))).alias("alpha"))


def score(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS, part_tokens: int = PART_TOKENS
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10) of each row.

    ``train`` says which rows the model learns from (null: it does). ``base_score`` is the add-one unigram score.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(train, F.lit(True)).alias("training"), F.col(text).cast("binary").alias("text"))
    unigrams = summarise(stage(unigram_table(rows), "unigrams"), shuffle_width(spark), part_tokens)
    sent = rows.mapInArrow(_send(unigrams.parts, frozenset(unigrams.frequent), block_tokens), "part int, block long, payload binary")
    answers = stage(sent.groupBy("part").applyInArrow(_answer(unigrams), ANSWERS), "answers")
    counted = answers.where("kind = 'classes'").agg(*[F.sum(f"n{r}") for r in range(1, K + 2)]).first()
    bigrams = Discounts.of([x or 0 for x in counted])
    backoffs = stage(backoff_table(answers, bigrams), "backoffs")
    whole = answers.where("kind in ('texts', 'answer')").select("kind", "block", "payload").groupBy("block")
    scored = whole.applyInArrow(_finish(unigrams, bigrams), "uid long, key long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    missed = answers.where("kind = 'backoff'").select("h", "uid", "n").join(backoffs, "h")
    missed = missed.select("uid", (F.col("n") * (F.log10("alpha") + F.log10("c"))).alias("more")).groupBy("uid").agg(F.sum("more").alias("more"))
    return scored.join(missed, "uid", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(unigrams.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
