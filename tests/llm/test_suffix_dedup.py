"""Removal of repeated byte strings against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import AWKWARD, COLUMNS
from conftest import SMALL
from leadlens.llm import queries, suffix_dedup


def plain_version(rows, threshold):
    """rows: (key, text) in their order -> (key, n_bytes, n_removed, spans, kept)."""
    seen, out = set(), []
    for key, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - threshold + 1):
            window = raw[at : at + threshold]
            if window in seen:
                gone[at : at + threshold] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).tolist()
        kept = bytes(b for b, g in zip(raw, gone.tolist()) if not g)
        out.append((key, len(raw), int(gone.sum()), tuple(zip(edges[::2], edges[1::2])), kept))
    return Counter(out)


def rows_of(made):
    return Counter((r[0], r.n_bytes, r.n_removed, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in made.collect())


def in_order(frame):
    """The operator's order: key (null last), then a hash of the text."""
    value = F.coalesce("text", F.lit("")).cast("binary")
    rows = frame.select("doc_id", "text", F.xxhash64(value).alias("h")).collect()
    return [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))]


def mixed_texts(seed):
    """Texts from few words, with copied passages, edits, and runs of one letter."""
    rng = random.Random(seed)
    words = [bytes(rng.choices(b"abcdexyz ", k=rng.randint(1, 7))).decode() for _ in range(40)] + ["é", "😀", "\n"]
    passages = [" ".join(rng.choices(words, k=rng.randint(2, 40))) for _ in range(6)]
    texts = []
    for _ in range(60):
        text = " ".join(rng.choice(passages) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 50)))
        texts.append(text + rng.choice(["", "a" * rng.randint(0, 60), "ab" * rng.randint(0, 60)]))
    for _ in range(15):
        old = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            old.insert(rng.randint(0, len(old)), rng.choice("abcxé"))
        texts.append("".join(old))
    return texts


@pytest.mark.parametrize("threshold,depths,piece", [(10, (3, 8, 10), 1 << 16), (20, (6, 17, 20), 64), (30, (8, 30), 200), (8, (1, 4, 7, 8), 40)])
def test_random_texts(spark, threshold, depths, piece):
    texts = mixed_texts(threshold)
    rows = [(k, x) for k, x in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (4, texts[9]), (None, texts[5]), (None, texts[5]), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = rows_of(suffix_dedup.remove_repeats(frame, threshold, depths, piece=piece))
    assert got == plain_version(in_order(frame), threshold)


def test_given_tables_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    shared = "A passage of a hundred bytes or more, which many documents hold between words of their own, whatever these are."
    hot = [(5000 + k, f"{k} {shared} {k * 7919}") for k in range(300)] + [(6000 + k, "copied " * 40) for k in range(200)]
    odd = spark.createDataFrame(AWKWARD, COLUMNS).unionByName(spark.createDataFrame(hot, "doc_id long, text string"), allowMissingColumns=True)
    clash = odd.withColumns({c: F.lit("x") for c in "none id hash start n lead hull deal state copies copy kept spans from blocks".split()})
    for frame in (docs, clash.repartition(7)):
        assert rows_of(suffix_dedup.remove_repeats(frame)) == plain_version(in_order(frame), 100)
    assert suffix_dedup.remove_repeats(clash.limit(0)).count() == 0
    assert rows_of(suffix_dedup.remove_repeats(clash.where("doc_id = 3"))) == Counter({(3, 0, 0, (), b""): 1})


def test_query(spark):
    got = {r.doc_id: r for r in queries.op13_suffix_dedup(spark, SMALL).collect()}
    for (key, size, removed, spans, kept), _ in plain_version(in_order(spark.read.parquet(f"{SMALL}/documents.parquet")), 100).items():
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, removed, len(spans), hashlib.sha256(kept).hexdigest())


def test_bad_depths(spark):
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for depths in ((100,), (50, 99), (60, 50, 100), (0, 100)):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeats(frame, 100, depths)


def test_shuffle_files_go_with_the_write(spark):
    from leadlens.llm.common import stage_free

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    assert stage_free(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "freed").count() == 7
    assert spark.conf.get(setting, None) == before


def test_memory_knows_only_later_places():
    memory = suffix_dedup.Memory(4)

    def repeats(*blocks):
        """blocks: (hull, (none, id, hash, start))"""
        hulls, places = zip(*blocks)
        return memory.repeats(np.array(hulls, np.uint64), [np.array(c) for c in zip(*places)]).tolist()

    here, before, after = (False, 5, 2, 10), (False, 5, 1, 90), (True, 0, 0, 0)
    assert repeats(((7, 1), here), ((6, 2), here)) == [False, False]
    # Neither the remembered place itself nor another hull with half the digest.
    assert repeats(((7, 1), here), ((6, 3), after)) == [False, False]
    assert repeats(((7, 1), after)) == [True]
    assert repeats(((7, 1), before)) == [False] and repeats(((7, 1), here)) == [True]
    assert repeats(((11, 1), here)) == [False] and repeats(((7, 1), after)) == [False]  # the slot was taken

    def groups(core, hull, shared):
        return [x.tolist() for x in memory.groups(np.array([core], np.uint64), np.array([hull], np.uint64), np.array([shared]))]

    assert groups(5, 1, False) == [[False], [False]]
    assert groups(5, 1, False) == [[False], [False]]
    assert groups(5, 2, False) == [[True], [False]]  # the first to be known as shared is sent
    assert groups(5, 2, False) == [[True], [True]]
    assert groups(9, 2, True) == [[True], [False]] and groups(5, 2, False) == [[False], [False]]


def test_hot_blocks_are_sent_once_a_task(spark):
    """A task sends a hull that it meets in every batch as one row, and its other occurrences as known repeats."""
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(k, False, k, "".join(rng.choices("abcdefgh ", k=900)) + line + "".join(rng.choices("abcdefgh ", k=900))) for k in range(200)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in ([r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows], [r[3].encode() for r in rows])], names=["none", "id", "hash", "text"])
    sent = pa.Table.from_batches(list(suffix_dedup._first_pass(100, 32, 4000)(iter([batch])))).to_pandas()
    groups = sent[sent.state != suffix_dedup.KNOWN].groupby(["deal"]).size()
    assert groups.max() <= 3 and (sent.state == suffix_dedup.KNOWN).sum() >= 190
