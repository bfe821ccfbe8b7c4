"""The queries of the test tables against plain versions, which go through every document one by one."""

import base64

import brute
import pytest
from conftest import tables_dir
from pyspark.sql import functions as F

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name, columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, FOLDER).select(*columns).collect())


def test_risk_rules(spark, docs):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(spark, "op1_risk_rules", columns) == sorted((d, *brute.counts(t)) for d, t in docs)
    assert not any(kept and failed for failed, kept in rows(spark, "op1_risk_rules", ("base_failed", "kept")))


def exact_tail(k, n, p):
    from math import comb

    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_risk_rules_learn_on_every_language(spark):
    """On the largest table: cutoffs and verdicts by a plain walk along the path, and what the rules do to labels they did not see."""
    from stackroom.llm import quality_rules as rules

    spec, folder = rules.RiskSpec(), "/root/testdata/sf0.1"
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op1_risk_rules"](spark, folder).join(langs, "doc_id").join(labels, "doc_id", "left").collect()
    good = {}
    for r in found:
        if r.quality == 1 and not r.base_failed:
            good.setdefault(r.lang, []).append(r)
    tested = [lang for lang, rows_ in good.items() if len(rows_) >= spec.fewest()]
    assert len(tested) == 4
    for lang in tested:
        cutoffs = dict.fromkeys(rules.LADDERS)
        for rule, cutoff in rules.PATH:
            tried = {**cutoffs, rule: cutoff}
            k = sum(any(c is not None and r[x] > c for x, c in tried.items()) for r in good[lang])
            if exact_tail(k, len(good[lang]), spec.risk) > spec.error / len(tested):
                break
            cutoffs = tried
        assert any(c is not None for c in cutoffs.values())
        for r in found:
            if r.lang == lang:
                assert all(r[f"{x}_cutoff"] == c for x, c in cutoffs.items())
                over = any(c is not None and r[x] > c for x, c in cutoffs.items())
                assert r.kept == (not r.base_failed and not over)

    # Cutoffs from one half of the labels, false rejections counted on the other.
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = labels.where("crc32(cast(doc_id AS string)) % 2 = 0")
    judged = rules.judge(docs, half).join(labels.join(half, "doc_id", "left_anti"), "doc_id").where("quality = 1 AND NOT base_failed")
    for r in judged.groupBy("stratum").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("lost")).collect():
        assert r.lost <= 0.04 * r.n, "twice the risk, for halves of some hundred labels"


def test_byte_cnn(spark):
    """On the larger table, whose labels suffice: documents held out from training are ranked and kept well."""
    found = QUERIES["op2_byte_cnn"](spark, tables_dir()).join(spark.read.parquet(f"{tables_dir()}/labels.parquet"), "doc_id")
    held = [(r.score, r.predicted, r.quality) for r in found.where("held_out").collect()]
    assert len(held) > 40 and all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in held)
    good, bad = [s for s, _, q in held if q == 1], [s for s, _, q in held if q == 0]
    pairs = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.95
    assert sum(p for _, p, q in held if q == 1) >= 0.98 * len(good)


def test_blob_ledger(spark, docs):
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert rows(spark, "op3_blob_ledger", columns) == sorted((d, *brute.secrets(t)) for d, t in docs)


def test_bwt_merge(spark, docs):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(spark, "op4_bwt_merge", columns) == sorted((d, *x) for d, x in brute.repeats(docs).items())


def test_heavy_light_join(spark, docs):
    columns = ("doc_id", "n_shingles", "component_id")
    assert rows(spark, "op5_heavy_light_join", columns) == sorted((d, *x) for d, x in brute.components(docs).items())


def test_compact_windows(spark, docs):
    """Every passage of 50 words that stands in a smaller document is covered, and every row is as similar as it says."""
    words = {d: brute.SPACE_WORD.findall((t or "").translate(brute.LOWER)) for d, t in docs}
    covered = {d: set() for d in words}
    columns = ("doc_id", "start", "end", "partner_id", "partner_start", "partner_end", "similarity")
    for d, a, b, p, c, e, similarity in rows(spark, "op6_compact_windows", columns):
        covered[d] |= set(range(a, b))
        mine, theirs = ({tuple(words[x][i : i + 5]) for i in range(s, t - 4)} for x, s, t in ((d, a, b), (p, c, e)))
        assert p < d and similarity >= 0.75
        assert abs(similarity - len(mine & theirs) / len(mine | theirs)) < 1e-9
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 49):
            if first.setdefault(tuple(words[d][i : i + 50]), d) < d:
                assert set(range(i, i + 50)) <= covered[d]


def test_prefix_windows(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(spark, "op7_prefix_windows", columns) == sorted(brute.contamination(docs, items))


def test_dictionary_warc(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(spark, "op8_dictionary_warc", columns) == sorted(brute.archive(pages))


def test_patience_licenses(spark, docs):
    found = QUERIES["op9_patience_licenses"](spark, FOLDER).select("doc_id", "licenses").collect()
    lines = {
        "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
        "mit-line": "Released under the MIT License.",
        "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    }
    wanted = {d: {name for name, line in lines.items() if line in (t or "")} for d, t in docs}
    assert len(found) == len(docs) and any(wanted.values())
    assert all(wanted[r.doc_id] <= set(r.licenses) for r in found)
    assert all(not r.licenses for r in found if "licen" not in (dict(docs)[r.doc_id] or "").lower())


def test_folded_bpe(spark, docs):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc, text in docs:
        ids = encoding.encode_ordinary(text or "")
        expected.append((doc, len(ids), brute.sha256(",".join(map(str, ids))), brute.sha256(text or "")))
    assert rows(spark, "op10_folded_bpe", ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == sorted(expected)


def test_pipeline_stages(spark):
    """Each stage by its rule on its own input, whole tables."""
    import corpus_pipeline as pipeline

    before = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = before.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES:
        after = stage(spark, before, FOLDER).cache()
        had = {r.doc_id: r for r in before.collect()}
        has = {r.doc_id: r for r in after.collect()}
        assert set(has) <= set(had) and len(has) == after.count()
        texts = [(d, r.text) for d, r in had.items()]
        if name != "tokens":
            assert after.columns == columns
        if name == "near_duplicates":
            assert set(has) == {d for d, (_, head) in brute.components(texts).items() if head == d}
        elif name == "contamination":
            assert set(has) == {x[0] for x in brute.contamination(texts, items) if not x[-1]}
        elif name == "secrets":
            assert set(has) == set(had)
            for d, r in has.items():
                assert r.n_chars == len(r.text) and (r.text == had[d].text) == (not brute.secrets(had[d].text)[-1])
                assert not brute.secrets(r.text)[-1]
        elif name == "tokens":
            assert all(has[d].decoded_sha256 == brute.sha256(t or "") for d, t in texts)
        before = after.select(*columns) if name != "tokens" else None
    assert pipeline.run(spark, FOLDER).where(F.col("n_tokens") == 0).count() == 0
