"""Ball-tree search against a ranking of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import AWKWARD, COLUMNS
from conftest import SMALL
from leadlens.llm import balltree


def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def ranking(docs, items, k=10):
    """docs: (doc_id, text), items: (item_id, text) -> all (item_id, rank, doc_id, score)."""
    counted = [(i, Counter(terms_of(x))) for i, x in docs]
    filled = [c.total() for _, c in counted if c]
    n_docs, total = len(filled), sum(filled)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts in counted:
            if counts:
                m = 25 + 75 * counts.total() * n_docs // total
                parts = (math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in terms_of(text) if t in counts)
                scores.append((-sum(parts), doc is None, doc or 0, doc))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(best, 1)]
    return Counter(out)


def rows_of(frame):
    return Counter(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ties = [(1000 + k % 7, "the same mat and cat, said STRASSE straße", "en", "t", 1) for k in range(30)] + [(None, "the mat", None, None, None)] * 3
    return docs.unionByName(spark.createDataFrame(AWKWARD + ties, COLUMNS)).withColumns({c: F.lit("x") for c in "n terms tfs item score rank".split()})


@pytest.fixture(scope="module")
def items(spark):
    odd = [(900, None), (901, ""), (902, "?!"), (903, "The MAT, the cat!"), (903, "the cat"), (None, "cat straße"), (904, "zzzz never seen"), (905, "Ünïcode İstanbul 😀 x2y")]
    return spark.read.parquet(f"{SMALL}/benchmark.parquet").unionByName(spark.createDataFrame(odd, "item_id long, text string"))


def test_ranks_as_brute_force(documents, items):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    assert rows_of(balltree.search(documents, items)) == ranking(docs, asked)
    assert rows_of(balltree.search(documents, items.where("item_id >= 900"), k=3)) == ranking(docs, [i for i in asked if (i[0] or 0) >= 900], 3)


def test_small_blocks_and_trees(documents, items, monkeypatch):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    few = items.where("item_id < 6 or item_id > 900")
    asked = [tuple(r) for r in few.select("item_id", "text").collect()]
    for name, value in (("CHUNK", 40), ("LEAF", 4), ("SLICE", 50)):
        monkeypatch.setattr(balltree, name, value)
    found = list(balltree.blocks(iter(asked), 3, 60))
    assert len(found) > 3 and all(len(b.items) <= 3 and (len(b.vocabulary) <= 60 or len(b.items) == 1) for b in found)
    assert rows_of(balltree.search(documents, few)) == ranking(docs, asked)


def test_empty(spark, documents, items):
    assert balltree.search(documents.limit(0), items).count() == 0
    assert balltree.search(documents, items.limit(0)).count() == 0
    assert balltree.search(documents, items.where("text is null")).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert balltree.search(blank, items).count() == 0


@pytest.mark.parametrize("size", [1, 7, 50])
def test_terms_by_slices(monkeypatch, size):
    monkeypatch.setattr(balltree, "SLICE", size)
    for text in ["", "a", "one TWO two-three  é ß" * 9, "x" * 400, " " * 300 + "end", "a b" * 60]:
        n, counts = balltree.term_counts(text.encode())
        want = Counter(t.encode() for t in terms_of(text))
        assert counts == want and n == want.total()


def random_rows(rng, n, width, centres):
    """Rows around a few centres, with some exact copies."""
    base = rng.integers(0, 1000, (centres, width)) * (rng.random((centres, width)) < 0.2)
    x = base[rng.integers(0, centres, n)] + (rng.random((n, width)) < 0.02)
    x[:, 0] += 1  # no row is empty
    x[n // 2 :: 5] = x[3]
    at, term = np.nonzero(x)
    return x, balltree.Rows(np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n)))), term, x[at, term].astype(np.int64) * 1000)


def test_tree_is_exact_and_prunes():
    rng = np.random.default_rng(5)
    x, rows = random_rows(rng, 3000, 200, 12)
    tree = balltree.BallTree(rows, 200, leaf=16)
    leaves = sum(c is None for c in tree.children)
    assert sorted(tree.order.tolist()) == list(range(3000))
    opened = []
    for _ in range(40):
        terms = np.sort(rng.choice(200, 15, replace=False))
        values = rng.integers(1, 9000, 15)
        best = balltree.Best(10)
        best.keys = list(range(3000))
        opened.append(tree.search(terms, values, best))
        products = (x[:, terms] * 1000) @ values
        want = sorted(range(3000), key=lambda k: (-products[k], k))[:10]
        assert best.rows() == [(k, int(products[k])) for k in want if products[k] > 0]
    assert sum(opened) < 0.3 * 40 * leaves


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x, rows = random_rows(rng, 500, 60, 5)
    rows.values *= 997  # up to 997 million, within 32 bits
    tree = balltree.BallTree(rows, 60, leaf=8)
    for (low, high), centre, radius, top in zip(tree.spans, tree.centroids, tree.radii, tree.tops):
        inside = x[tree.order[low:high]] * 997_000.0
        assert (np.sqrt(((inside - centre) ** 2).sum(1)) <= radius).all()
        assert (top == inside.max(0)).all()


def test_documents_without_common_passages_are_pruned(spark):
    """Texts of the supplied table, where balls are wide: the radii by component prune most leaves."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    asked = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    block = next(balltree.blocks(iter(asked)))
    counted = [(key, *balltree.term_counts(x.encode())) for key, x in docs]
    found = [(key, n, sorted((block.vocabulary[t], c) for t, c in counts.items() if t in block.vocabulary)) for key, n, counts in counted]
    found = [f for f in found if f[2]][:8000]
    sizes = np.array([len(f[2]) for f in found])
    terms, tf = (np.array([p[k] for f in found for p in f[2]]) for k in (0, 1))
    n = np.array([f[1] for f in found])
    m = np.repeat(balltree.length_factor(n, len(n), int(n.sum())), sizes)
    width, df = len(block.vocabulary), np.bincount(terms, minlength=len(block.vocabulary))
    tree = balltree.BallTree(balltree.Rows(np.concatenate(([0], np.cumsum(sizes))), terms, balltree.component(tf, m)), width)
    opened = 0
    for _, _, repeats in block.items:
        places = np.array(sorted(repeats))
        best = balltree.Best(10)
        best.keys = [f[0] for f in found]
        opened += tree.search(places, np.array([balltree.weight(len(n), int(df[t])) * repeats[t] for t in places.tolist()]), best)
    assert opened < 0.6 * len(block.items) * sum(c is None for c in tree.children)
