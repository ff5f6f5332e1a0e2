"""The registered queries and the pipeline over the smallest tables, column by column against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import linked_components, words_of

import corpus_pipeline
from weftline.llm import embedding_dedup, exact_dedup, language_model, mixing, ngram_join, packing, quality, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def held(doc_id, n, what):
    return zlib.crc32(str(doc_id).encode()) % n == what


def test_packing_query(spark, documents):
    encode = packing.encoder()
    pieces = defaultdict(list)
    rows = packing.op2_packing(spark, SF).collect()
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(documents)
    for i, text in documents.items():
        ids = np.array([*encode(text or ""), 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset, r.ids_crc32) == (at, len(ids), 0, zlib.crc32(ids[at : at + r.length].tobytes())) and r.length in {1 << k for k in range(12)}
            at += r.length
        assert at == len(ids)
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_ngram_join_query(spark, documents):
    got = ngram_join.op3_ngram_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked_components(documents.items()) and len(got) == len(documents)


def test_quality_query(spark, documents):
    got = {r.doc_id: r for r in quality.op6_quality(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == held(i, 4, 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    sides = [[got[i].score for i in labels if got[i].held_out and labels[i] == k] for k in (0, 1)]
    if all(sides):
        assert np.mean([(a < b) + (a == b) / 2 for a in sides[0] for b in sides[1]]) > 0.8


def test_toxicity_query(spark, documents):
    got = {r.doc_id: r for r in toxicity.op5_toxicity(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == held(i, 4, 2) and 0 <= r.expected_severity <= 3 and r.toxic == (r.p_toxic >= toxicity.REJECT) and r.grade in range(4)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([got[i].toxic == bool(v) for i, v in labels.items() if v is not None and got[i].held_out]) > 0.9


def test_embedding_query(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) if r.embedding is not None else None for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    fine = {i: v / np.linalg.norm(v) for i, v in vectors.items() if v is not None and np.isfinite(v).all() and v.any()}
    ids = sorted(fine)
    close = np.stack([fine[i] for i in ids]) @ np.stack([fine[i] for i in ids]).T >= 0.95
    np.fill_diagonal(close, False)
    root = {i: i for i in vectors}
    changed = True
    while changed:
        changed = False
        for a, b in np.argwhere(close):
            low = min(root[ids[a]], root[ids[b]])
            changed |= root[ids[a]] != low or root[ids[b]] != low
            root[ids[a]] = root[ids[b]] = low
    links = dict(zip(ids, close.sum(1)))
    got = embedding_dedup.op7_embedding_dedup(spark, SF).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted((i, links.get(i, 0), root[i], root[i] == i) for i in vectors)


def test_language_model_query(spark, documents):
    counts = Counter(t for i, text in documents.items() if not held(i, 10, 0) for t in [*words_of(text), None])
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in language_model.op9_language_model(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, text in documents.items():
        tokens, r = [*words_of(text), None], got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i, 10, 0), len(tokens), sum(t in counts for t in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens), rel_tol=1e-9) and r.score <= 0


def test_pipeline_stage_by_stage(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: tuple(r) for r in docs.collect()}
    taken = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        kept = docs.collect()
        assert all(tuple(r) == rows[r.doc_id] for r in kept)
        docs = spark.createDataFrame(kept, docs.schema)
        taken.append(Counter(r.doc_id for r in kept))
    toxic = {r.doc_id for r in toxicity.op5_toxicity(spark, SF).where("toxic").collect()}
    assert set(taken[0]) == set(rows) - toxic
    last = {}
    for i in taken[0]:
        last[documents[i] or ""] = max(i, last.get(documents[i] or "", i))
    assert set(taken[1]) == set(last.values())
    classes = linked_components((i, documents[i]) for i in taken[1])
    assert set(taken[2]) == {i for i, (n, c) in classes.items() if n == 0 or i == c} and set(taken[2].values()) == {1}
    source = spark.createDataFrame([rows[i] for i in taken[2]], docs.schema)
    repeats = {r.doc_id: max(r.repeats, int(r["size"] == 0)) for r in mixing.mix(source).collect()}
    assert taken[3] == Counter({i: n for i, n in repeats.items() if n})
    encode = packing.encoder()
    got = corpus_pipeline.run(spark, SF).collect()
    whole = defaultdict(list)
    for r in got:
        whole[r.doc_id].append((r.start, list(r.ids)))
    for i, n in taken[3].items():
        ids = [*encode(documents[i] or ""), 1]
        assert sorted(whole[i]) == sorted([(s, ids[s : s + k]) for s, k in zip(np.cumsum([0, *packing.piece_lengths(len(ids))]), packing.piece_lengths(len(ids)))] * n)
    assert set(whole) == set(taken[3])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_exact_dedup_query(spark, documents):
    got = {r.doc_id: r for r in exact_dedup.op8_exact_dedup(spark, SF).collect()}
    groups = defaultdict(list)
    for i, text in documents.items():
        groups[text or ""].append(i)
    for same in groups.values():
        for i in same:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(same), len(same), i == max(same))
