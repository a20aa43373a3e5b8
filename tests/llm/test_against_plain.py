"""Every registered query of the corpus operators against its SQL or a plain version, on the small tables."""

import base64
import hashlib
import html as entities
import math
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from brute import license_row, markov_score, near_components, quality_counts, shingles
from martlake.llm import licenses, mixing, neardup, quality, tokens, toxicity, urls, vectors
from martlake.llm.common import prepare
from martlake.llm.queries import ORACLES, QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents labels pages embeddings".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    order = sorted(df.columns)
    found = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == order
    wanted = sorted((tuple(r[columns.index(c)] for c in order) for r in result.fetchall()), key=repr)
    assert found == wanted


def test_near_duplicates(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op1_odd_sketch_dedup"](spark, FOLDER).collect()}
    wanted = near_components(texts, 85)
    assert len(found) == len(texts)
    for i, text in texts:
        assert (found[i].n_shingles, found[i].component_id) == (len(shingles(text)), wanted[i])
        assert found[i].kept == (wanted[i] == i)


def test_quality(spark, duck, texts):
    found = {r.doc_id: r for r in QUERIES["op2_risk_controlled_rules"](spark, FOLDER).collect()}
    for i, text in texts:
        counts = quality_counts(text)
        assert {c: found[i][c] for c in counts} == counts
        failed = counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]
        assert found[i].base_failed == failed
        assert not (failed and found[i].kept)
    good = [i for i, q in duck.sql("SELECT doc_id, quality FROM labels").fetchall() if q and not found[i].base_failed]
    assert np.mean([found[i].kept for i in good]) >= 1 - quality.RISK


def test_bpe(spark, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in QUERIES["op4_sql_bpe"](spark, FOLDER).collect()}
    for i, text in texts:
        ids = library.encode_ordinary(text)
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_main_text(spark, duck):
    found = {r.page_id: r for r in QUERIES["op6_tag_path_text"](spark, FOLDER).collect()}
    for i, page in duck.sql("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", article)))
        wanted = "\n\n".join(t for t in (" ".join(entities.unescape(b).split()) for b in blocks) if t)
        assert found[i].text == wanted
        assert found[i].n_chars == len(wanted)


def test_licenses(spark, texts):
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_license_join"](spark, FOLDER).collect()}
    for i, text in texts:
        assert found[i] == license_row(
            text, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD, licenses.SPAN
        )


def test_nearest(spark, duck):
    rows = duck.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    found = {}
    for r in QUERIES["op8_multi_index"](spark, FOLDER).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    hits = total = 0
    for query, own in found.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, min(20, len(ids) - 1) + 1))
        products = matrix @ matrix[ids == query][0]
        for r in own:
            assert r.vec_id != query and math.isclose(r.score, products[ids == r.vec_id][0], abs_tol=1e-12)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        best = [i for i in ids[np.lexsort((ids, -products))] if i != query][:20]
        hits += len(set(best) & {r.vec_id for r in own})
        total += len(best)
    assert hits / total >= 0.9


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    toxic = np.array([r.score for r in scored if r.toxic])
    plain = np.array([r.score for r in scored if not r.toxic])
    assert (toxic[:, None] > plain[None, :]).mean() > 0.8
    assert (plain >= 0.5).mean() < 0.03


def rule_of(host, path):
    fits = [
        (h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_urls(spark, duck):
    found = {r.page_id: r for r in QUERIES["op10_url_language_model"](spark, FOLDER).collect()}
    accepted, rejected, subjects = set(), set(), {}
    for i, url in duck.sql("SELECT page_id, url FROM pages").fetchall():
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        rule, verdict = rule_of(host, path)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        if verdict:
            assert found[i].verdict == verdict
        bad = any(w in host for w in urls.REJECTED_WORDS)
        subjects[i] = host + path
        (rejected if bad or verdict == "block" else accepted if verdict else set()).add(host + path)
    counted = lambda s: sorted(x for x in s if zlib.crc32(x.encode()) % 5)
    accepted, rejected = counted(accepted - rejected), counted(rejected)
    for i in sorted(subjects)[:25]:
        wanted = markov_score(subjects[i], accepted, rejected, urls.ORDER, urls.CHARACTERS, urls.START)
        assert math.isclose(found[i].score, wanted, rel_tol=1e-9, abs_tol=1e-12)
    ruled = [r for r in found.values() if r.rule is None]
    least = max((r.score for r in ruled if r.verdict == "block"), default=-math.inf)
    assert all(r.score > least for r in ruled if r.verdict == "allow")


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    prepare(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        out[name] = stage(spark, docs, FOLDER).cache()
        if name != pipeline.STAGES[-1][0]:
            assert out[name].schema.names == docs.schema.names
        before, docs = docs, out[name]
        ids = {r.doc_id for r in before.collect()}
        kept = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(kept) <= ids
        if name == "MinHash near-dedup":
            wanted = near_components([(r.doc_id, r.text) for r in before.collect()], 80)
            assert sorted(kept) == sorted(i for i, c in wanted.items() if i == c)
        elif name == "quality rules":
            judged = quality.quality_rules(before, labels).filter("kept")
            assert sorted(kept) == sorted(r.doc_id for r in judged.collect())
        elif name == "mixing sources to target weights":
            plan = {r.source: r for r in mixing.mix_plan(mixing.sized(mixing.keyed(before, "key", "doc_id", "text"), "key")).collect()}
            words = {s: 0 for s in plan}
            for r in docs.collect():
                words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            for s, p in plan.items():
                longest = max(len((r.text or "").split()) for r in before.collect() if r.source == s)
                assert abs(words[s] - p.target) <= longest
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in docs.collect())
    assert docs.count() == out["mixing sources to target weights"].count()


def test_pipeline_runs_as_a_query(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"](spark, FOLDER).columns[:3] == ["doc_id", "lang", "source"]
    assert set(QUERIES) <= set(entry.queries())


def test_neardup_bounds():
    for percent in (80, 85):
        share = (percent / 100) ** neardup.ROWS
        assert (1 - share) ** neardup.n_bands(percent) <= neardup.MISS


def test_index_walks_cells_in_order():
    index = vectors.Index(np.random.default_rng(1).normal(size=(300, 6)), 5)
    query = np.random.default_rng(2).normal(size=6)
    index.sizes = {c: 1 for c in range(25)}
    walked = index.walk(query, 25)
    products = [
        float(index.books[0][c // 5] @ query[:3] + index.books[1][c % 5] @ query[3:]) for c in walked
    ]
    assert len(set(walked)) == 25
    assert all(a >= b - 1e-12 for a, b in zip(products, products[1:]))


def test_groups_cover_texts():
    texts = ["a" * n for n in (5, 0, 2_000_000, 10, 399_995, 5, 1)]
    spans = list(tokens.text_groups(texts))
    assert [k for i, j in spans for k in range(i, j)] == list(range(len(texts)))
