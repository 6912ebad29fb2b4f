"""Fill-in-the-middle against a plain version and its own inverse."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import AWKWARD, COLUMNS
from conftest import SMALL
from leadlens.llm import fim

ODD = [
    (20, "one line", None, None, None),
    (21, "a\nb\nc", None, None, None),
    (22, "a\nb\nc\n", None, None, None),
    (23, "\n\n\n", None, None, None),
    (24, "\r\n x\x85y\n z", None, None, None),
    (25, "has <M> inside\nline", None, None, None),
    (26, "almost <P\n<S\n>\n<", None, None, None),
    (-3, "negative\nkey", None, None, None),
    (27, "line\n" * 60_000, None, None, None),
    (28, "x" * 2_000_000 + "\nend", None, None, None),
]


def plain_version(key, text, percent=100, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, None, text
    if h[3] % 100 < 50:
        return n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent", [100, 40, 0])
def test_cuts_and_restores(spark, percent):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(AWKWARD + ODD + ODD[:2], COLUMNS)
    clash = odd.withColumns({c: F.lit("x") for c in "row value cuts units low high form prefix middle suffix output whether which".split()})
    for frame in (docs, clash):
        made = fim.transform(frame, percent=percent)
        got = made.select("row.doc_id", "row.text", "units", "form", "prefix", "middle", "suffix", "output", fim.restore(F.col("form"), F.col("output")).alias("restored")).collect()
        assert Counter((r.doc_id, r.text, *r[2:8]) for r in got) == Counter((i, x, *plain_version(i, x, percent)) for i, x in (tuple(r) for r in frame.select("doc_id", "text").collect()))
        assert all(r.restored == (r.text or "") for r in got)
    assert fim.transform(odd.limit(0)).count() == 0


def test_all_forms_occur(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert {r.form for r in fim.transform(docs, percent=60).select("form").distinct().collect()} == {"plain", "psm", "spm"}
