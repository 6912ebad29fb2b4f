"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from . import balltree, fim, html_text, katz, merkle, mixing, packing, quality, secret_scan, simhash, suffix_dedup, urls, warc
from .common import table

Run = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
MIX = mixing.Mix(most_epochs=2.0)
URL_RULES = [
    urls.UrlRule("allow", "org/"),
    urls.UrlRule("block", "example.org/es/"),
    urls.UrlRule("block", "example.org/en/1"),
    urls.UrlRule("allow", "com/fr/"),
    urls.UrlRule("block", "com/de/"),
]


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"), MIX)


def op2_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.fit(pages))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(kinds: tuple[str, ...] | None):
        picked = F.filter("spans", lambda s: s["kind"].isin(*kinds)) if kinds else F.col("spans")
        return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = ("assign", "access", "hex")
    counts = [count(kind) for kind in base]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(None).alias("spans"))


def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return katz.score(table(spark, sf_dir, "documents"), train)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.exists("failed", lambda f: f.isin(*quality.BASE_RULES))
    counts = [f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("row.doc_id", *counts, base.alias("base_failed"), "kept", F.array_join("failed", ",").alias("failed_rules"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = merkle.compare_edits(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        F.length("value").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        merkle.encode(F.col("tree")).alias("fingerprint"),
        merkle.encode(F.col("edited_tree")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = stage(warc.archive(table(spark, sf_dir, "pages")), "bundles")
    return warc.read(bundles).select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, URL_RULES, urls.fit(pages, URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(value):
        return F.sha2(value.cast("binary"), 256)

    return made.select(
        "row.doc_id",
        F.col("units").alias("n"),
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restore(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


REGISTRY: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_temperature_mixing,
        op2_bin_slack_packing,
        op3_main_text,
        op4_secret_scan,
        op5_katz_backoff,
        op6_quality_rules,
        op7_simhash,
        op8_merkle_fingerprints,
        op9_warc_bundles,
        op10_url_filter,
        op11_fill_in_middle,
        op12_ball_tree_search,
        op13_suffix_dedup,
        pipeline,
    )
}

WORD = r"[^\x20\x09-\x0D]+"

_STOP_WORDS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

#: DuckDB statements, where SQL can express the whole result. The other queries are tested against brute force in tests/llm.
SQL: dict[str, str] = {
    "op6_quality_rules": rf"""
    WITH source AS (
        SELECT doc_id, coalesce(text, '') AS value, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM source),
    windows AS (
        SELECT doc_id, i, word || ' ' || lead(word) OVER own || ' ' || lead(word, 2) OVER own AS triple FROM placed WINDOW own AS (PARTITION BY doc_id ORDER BY i)
    ), twice AS (
        SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, triple) AS n FROM windows WHERE triple IS NOT NULL) WHERE n > 1
    ), covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id),
    counted AS (
        SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
            len(regexp_extract_all(value, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            list_filter(string_split(value, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
            coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(list_filter(words, lambda x: lower(x) IN ({_STOP_WORDS}))) AS n_stop
        FROM source s LEFT JOIN covered c USING (doc_id)
    ), judged AS (
        SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
            list_filter([
                CASE WHEN n_words < 50 THEN 'length' END,
                CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeats' END,
                CASE WHEN word_chars < 1.5 * n_words OR n_words = 0 OR word_chars > 20 * n_words THEN 'long_words' END,
                CASE WHEN 10 * n_symbols > 3 * n_words THEN 'symbols' END,
                CASE WHEN 2 * (len(lines) - len(list_distinct(lines))) > len(lines) THEN 'lines' END,
                CASE WHEN 100 * n_stop < n_words OR n_words = 0 THEN 'stop_words' END
            ], lambda x: x IS NOT NULL) AS failed
        FROM counted
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        list_contains(failed, 'length') OR list_contains(failed, 'repeats') AS base_failed, len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
    FROM judged
    """,
    "op9_warc_bundles": """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads)
    SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM firsts
    """,
    "op13_suffix_dedup": """
    WITH source AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
    chunks AS (SELECT doc_id, c, substr(digits, 2 * c + 1, 2 * (500 + 99)) AS part, n_bytes FROM source, unnest(range(0, n_bytes, 500)) AS t(c)),
    windows AS (
        SELECT doc_id, c + p AS start, md5(substr(part, 2 * p + 1, 200)) AS bytes FROM chunks, unnest(range(0, 500)) AS t(p) WHERE c + p + 100 <= n_bytes
    ), again AS (
        SELECT doc_id, start FROM (SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, start) AS n FROM windows) WHERE n > 1
    ), marked AS (
        SELECT *, CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100 THEN 0 ELSE 1 END AS opens FROM again
    ), grouped AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM marked),
    spans AS (SELECT doc_id, min(start) AS low, max(start) + 100 AS high FROM grouped GROUP BY doc_id, run),
    edges AS (
        SELECT doc_id, count(*) AS n_spans, sum(high - low)::BIGINT AS n_removed, list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs FROM spans GROUP BY doc_id
    ), whole AS (
        SELECT doc_id, digits, n_bytes, coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(n_removed, 0)::BIGINT AS n_removed,
            list_concat([0::BIGINT], coalesce(highs, []::BIGINT[])) AS froms, list_concat(coalesce(lows, []::BIGINT[]), [n_bytes]) AS tos
        FROM source LEFT JOIN edges USING (doc_id)
    )
    SELECT doc_id, n_bytes, n_removed, n_spans,
        sha256(unhex(array_to_string(list_transform(range(1, len(froms) + 1), lambda k: substr(digits, 2 * froms[k] + 1, 2 * (tos[k] - froms[k]))), ''))) AS kept_sha256
    FROM whole
    """,
    "op11_fill_in_middle": r"""
    WITH source AS (
        SELECT doc_id, coalesce(text, '') AS value, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest,
            regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
        FROM documents
    ), drawn AS (
        SELECT *, len(units) AS n, ('0x' || digest[1:8])::BIGINT % (len(units) + 1) AS one, ('0x' || digest[9:16])::BIGINT % (len(units) + 1) AS two,
            CASE WHEN value = '' OR contains(value, '<P>') OR contains(value, '<S>') OR contains(value, '<M>') OR ('0x' || digest[17:24])::BIGINT % 100 >= 100 THEN 'plain'
                WHEN ('0x' || digest[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM source
    ), pieces AS (
        SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix,
            array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle, array_to_string(units[greatest(one, two) + 1:], '') AS suffix
        FROM drawn
    )
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN value WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(CASE form WHEN 'plain' THEN value ELSE prefix || middle || suffix END) AS restored_sha256
    FROM pieces
    """,
    "op12_ball_tree_search": r"""
    WITH terms AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
    ), asked AS (
        SELECT item_id, term, count(*) AS repeats FROM (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
    ), lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    total AS (SELECT count(*) AS N_docs, sum(n)::BIGINT AS L FROM lengths),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(N_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, total GROUP BY term
    ), scores AS (
        SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * N_docs) // L)))))::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), total GROUP BY ALL
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
