"""Nulls, clashing columns, repeated rows, empty tables and odd numbers, over the pipeline's stages and the operators."""

import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import common, embedding_dedup, exact_dedup, mixing, ngram_join, packing, pii, quality, textkit, toxicity

CLASHING = "row, h, size, s, base, limit, source_size, target, digest, nth, heavy_size, heavy_keep, p_toxic, grade, expected_severity, __hash, __drop, __h, node, component_id, taken"
STAGES = {
    "toxicity": lambda docs, labels: toxicity.drop_toxic(docs, labels),
    "exact_dedup": lambda docs, labels: exact_dedup.keep_one(docs),
    "ngram_join": lambda docs, labels: ngram_join.one_of_each(docs),
    "mixing": lambda docs, labels: mixing.mixed_rows(docs),
}


@pytest.fixture(scope="module")
def given(spark):
    long = "some words of a long text that stands here twice " * 4
    rows = [(None, None, None), (None, "no id", "a"), (1, None, None), (2, "", "a"), (3, " \t\n", "b"), (4, "a b c", "b"), (5, "A  b c", "b"), (7, long, "c"), (7, long, "c"), (8, long, None), (9, "y" * 100_000, "a")]
    names = CLASHING.split(", ")
    docs = spark.createDataFrame([(*r, *[f"{n}{k}" for n in names]) for k, r in enumerate(rows)], f"doc_id long, text string, source string, {', '.join(f'`{n}` string' for n in names)}")
    labels = spark.createDataFrame([(4, 0), (9, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    return docs, labels


@pytest.mark.parametrize("name", STAGES)
@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_of_any_name(given, name, empty):
    docs, labels = (x.limit(0) if empty else x for x in given)
    out = STAGES[name](docs, labels)
    assert out.columns == docs.columns
    got, all_rows = [tuple(r) for r in out.collect()], [tuple(r) for r in docs.collect()]
    assert set(got) <= set(all_rows)
    texts = [r[1] for r in got]
    if empty:
        assert got == []
    elif name == "exact_dedup":
        assert sorted(t or "" for t in texts) == sorted({r[1] or "" for r in all_rows})
    elif name == "ngram_join":
        assert sorted((r[0] or 0, r[1] or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in all_rows if r[0] not in (5, 8))
    elif name == "toxicity":
        assert sorted(map(repr, got)) == sorted(map(repr, all_rows))  # nothing tells one toxic row apart


def test_mixed_rows_come_as_often_as_the_mix_takes_them(given):
    docs, _ = given
    want = {(r.doc_id, r.h): max(r.repeats, int(r["size"] == 0)) for r in mixing.mix(docs).collect()}
    rows = docs.groupBy("doc_id", mixing.hash_of().alias("h")).count().collect()
    taken = {(r.doc_id, r.h): r["count"] for r in mixing.mixed_rows(docs).groupBy("doc_id", mixing.hash_of().alias("h")).count().collect()}
    assert taken == {(r.doc_id, r.h): r["count"] * want[r.doc_id, r.h] for r in rows if want[r.doc_id, r.h]}


def test_near_copies_are_listed_with_one_partner_each_before_the_tree(spark, monkeypatch):
    rnd = random.Random(11)
    base = [f"w{k}" for k in range(150)]

    def copy():
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 6, 9])):
            words[rnd.randrange(150)] = f"x{rnd.randrange(10**9)}"
        return words

    texts = [copy() for _ in range(1000)]
    listed = []
    verified = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *a: listed.append(pairs.count()) or verified(pairs, *a))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    sets = [{tuple(t[i : i + 5]) for i in range(146)} for t in texts]
    root = list(range(1000))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(1000):
        for j in range(i):
            if find(i) != find(j) and 180 * len(sets[i] & sets[j]) >= 80 * (len(sets[i]) + len(sets[j])):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(1000)}
    assert len(listed) == 3 and listed[0] <= 1000 and sum(listed) <= 4000


def test_join_to_classes_equals_a_plain_join(spark, monkeypatch):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 37).alias("k"))
    classes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 5")
    monkeypatch.setattr(common, "HEAVY", 0.1)
    got = common.join_to_classes(rows, classes, ["k"], "n", 1000)
    assert sorted(map(tuple, got.select("id", "k", "n").collect())) == sorted(map(tuple, rows.join(classes, "k").select("id", "k", "n").collect()))


def test_vectors_of_any_norm_and_rows_without_id(spark):
    big, small = 1e200, 1e-200
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [small, 0.0]), (4, [1.1 * small, 0.0]), (5, [big, big]), (6, [big, 1.1 * big]), (7, [5e-324, 0.0]), (None, [1.0, 0.0]), (None, [-1.0, 0.0]), (None, None), (8, [0.0, -1e308])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(vectors).collect()), key=repr)
    want = [(False, k, 5, 1, k == 1) for k in (1, 2, 3, 4, 7)] + [(False, k, 1, 5, k == 5) for k in (5, 6)] + [(False, 8, 0, 8, True)]
    want += [(True, 0, 5, 1, False), (True, 0, 0, None, True), (True, 0, 0, None, True)]
    assert got == sorted(want, key=repr)


def test_repeated_vector_ids_count_as_vectors(spark):
    vectors = spark.createDataFrame([(3, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.001])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(vectors).collect())
    assert got == [(2, 0, 2), (2, 2, 2), (3, 2, 2), (3, 2, 2)]


def test_packed_ids_are_those_of_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    slow, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(9)
    encode = packing.encoder()
    alphabet = "aeZ 09'\n\t.,_-ßéñ中文🙂 ​́" + "the "
    texts = ["", "<|endoftext|>", "x<|endoftext|>y", "it's I'LL we've", "   lead", "tail   ", "\r\n\r\n", "1234567890" * 30] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        assert encode(text) == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_and_pii_of_an_empty_table(spark, given):
    docs = given[0].limit(0)
    assert packing.pack(docs).count() == 0
    assert pii.find_pii(docs).count() == 0


def test_quality_learns_nothing_from_held_out_rows(spark):
    rnd = random.Random(8)
    rows = [(k, ("GOOD text, with sense. " if k % 2 else "xx || !! 00 ") * rnd.randint(3, 30), k % 2) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").select("doc_id", "text", F.lit("z").alias("score"), F.lit(1).alias("quality"))
    labels = spark.createDataFrame([(k, q) for k, _, q in rows] + [(None, 1), (5000, None)], "doc_id long, quality int")
    held = common.id_bucket(4) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = ({r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, x)).collect()} for x in (labels, turned))
    assert one == other and all((one[k] >= 0.5) == bool(k % 2) for k in one)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0
    twice = docs.union(docs)
    again = quality.score(twice, quality.fit(docs, labels)).collect()
    assert len(again) == 400 and all(math.isclose(r.score, one[r.doc_id]) for r in again)


def test_boosted_trees_walk_as_a_plain_traversal_does():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 5)).round(1)
    forest = quality.fit_forest(x, (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float), trees=12, depth=3)

    def one(row):
        total = forest.prior
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            j = 0
            for level in range(3):
                at = 2**level - 1 + j
                j = 2 * j + int(row[f[at]] > t[at])
            total += leaf[j]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(forest.predict(x), [one(r) for r in x])
    assert ((forest.predict(x) > 0.5) == (x[:, 0] + x[:, 1] ** 2 > 0.7)).mean() > 0.95


def test_quality_statistics_equal_plain_python():
    texts = ["One two two.\nthree! 4|5\n\nOne two two.", "ÄB c  d", "x"]
    [block] = textkit.blocks(pa.array(texts))
    got = quality.statistics(block)
    name = quality.STATISTICS.index
    for row, t in zip(got, texts):
        words, data = t.split(), t.encode()
        assert math.isclose(row[name("log_words")], math.log1p(len(words))) and math.isclose(row[name("log_bytes")], math.log1p(len(data)))
        assert math.isclose(row[name("word_length")], np.mean([len(w.encode()) for w in words]))
        assert math.isclose(row[name("digits")], sum(48 <= b <= 57 for b in data) / len(data))
        lines = [line for line in t.split("\n") if line]
        assert math.isclose(row[name("distinct_lines")], len(set(lines)) / len(lines))
        share = np.bincount(np.frombuffer(data, np.uint8))
        share = share[share > 0] / len(data)
        assert math.isclose(row[name("entropy")], -(share * np.log2(share)).sum(), abs_tol=1e-12)


def test_cumulative_link_equals_plain_python():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 3, (400, 4)).astype(float)
    severity = x @ np.array([1.0, 0.5, 0.0, 2.0])
    grade = np.digitize(severity, [1.5, 3.0, 4.5])
    model = toxicity.fit_ordinal(np.arange(4, dtype=np.uint64), x, grade)
    assert (np.diff(model.thresholds) > 0).all()
    p = model.above(x)
    plain = [[1 / (1 + math.exp(-(r @ model.weights - t))) for t in model.thresholds] for r in x]
    assert np.allclose(p, plain) and (np.diff(p, axis=1) < 0).all()
    assert np.corrcoef(p.sum(1), grade)[0, 1] > 0.95


PII_TEXTS = [f"call +1 ({n}) 555-{n + 1000} or bob.{n}@mail.example.com at 10.{n % 250}.3.4 now" for n in range(200, 230)]


def test_numbers_are_seen_as_by_the_plain_features():
    rnd = random.Random(2)
    model = pii.SemiMarkov()
    for _ in range(120):
        text = "".join(rnd.choice("0123456789999  ().-+a") for _ in range(rnd.randint(7, 40)))
        bounds = model.atoms(text, 0, len(text))
        for j in range(1, len(bounds)):
            got = {i: sorted(pii.number_features(seen)) for i, seen in pii.numbers_ending(text, bounds, j)}
            plain = {i: sorted(seen) for i in range(max(0, j - pii.MAX_ATOMS), j) if (seen := pii.features(text, bounds[i], bounds[j]))}
            assert got == plain, (text, j)


def test_decoding_equals_all_segmentations():
    model = pii.SemiMarkov().fit(pii.training_cases(PII_TEXTS))
    for text in ("(212) 555-0199", "10.2.3.4 5", "+44 20 7946", "joe (at) x.org"):
        bounds, by_end = model.lattice(text, 0, len(text))

        def all_of(j, after):
            """(score, segments) of every labeling up to bound j, by the type before what follows."""
            if j == 0:
                yield 0.0, (), 0
                return
            for score, segments, last in all_of(j - 1, after):
                yield score, segments, 0
            for i, kind, seen in by_end[j]:
                k = pii.KINDS.index(kind) + 1
                for score, segments, last in all_of(i, after):
                    yield score + model.w[f"after{last}", kind] + model.score(kind, seen), (*segments, (i, j, kind)), k

        every = list(all_of(len(bounds) - 1, None))
        z = pii.log_sum([x[0] for x in every])
        best = max(every, key=lambda x: x[0])[1]
        sure = [s for s in best if sum(math.exp(x[0] - z) for x in every if s in x[1]) >= pii.CERTAIN]
        assert model.decode(text, 0, len(text)) == [(bounds[i], bounds[j], kind) for i, j, kind in sure]
        for i, j, kind, _, each in model.marginals(by_end):
            assert math.isclose(each.sum(), sum(math.exp(x[0] - z) for x in every if (i, j, kind) in x[1]), abs_tol=1e-9)


def test_long_regions_take_bounded_memory():
    import tracemalloc

    model = pii.SemiMarkov().fit(pii.training_cases(PII_TEXTS))
    rnd = random.Random(6)
    text = " ".join(str(rnd.randrange(100)) for _ in range(3000))
    tracemalloc.start()
    pii.all_spans(text, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1500 * len(text)


def test_windows_hold_all_of_a_long_region():
    text = " ".join(f"10.0.{k % 256}.{k // 256}" for k in range(2000))
    parts = list(pii.windows(text))
    assert len(parts) > 50 and max(len(w[0]) for w in parts) < 400
    assert sum(len(w[3]) for w in parts) == len(pii.base_spans(text))
    assert all(w[0][s:e].count(".") == 3 and k == "ip" for w in parts for s, e, k in w[3])
    assert re.sub(" ", "", "".join(w[0][w[1] : w[2]] for w in parts)) == text.replace(" ", "")
    assert list(itertools.islice(pii.windows("nothing 1 here"), 1)) == []


def test_spans_are_found_as_by_a_look_at_all():
    rnd = random.Random(8)
    for _ in range(300):
        spans = [(s, s + rnd.randint(1, 12), rnd.choice(pii.KINDS)) for s in (rnd.randrange(60) for _ in range(rnd.randint(0, 12)))]
        own = pii.Spans(spans)
        for _ in range(20):
            a = rnd.randrange(70)
            b = a + rnd.randint(1, 15)
            assert own.covers(a, b) == any(s <= a and b <= e for s, e, _ in spans)
            assert own.meets(a, b) == any(s < b and a < e for s, e, _ in spans)
            assert own.inside(a, b) == sorted(x for x in spans if a <= x[0] and x[1] <= b)
            cut = a
            for s, e, _ in sorted(spans):
                cut = e if s < cut < e else cut
            assert own.after(a) == cut


def test_lists_of_addresses_take_time_in_proportion():
    """4 MB of addresses; a look at all spans for each one took 17 minutes."""
    text = "".join(f"user{k}@example{k % 7}.org, " for k in range(160_000))
    began = time.time()
    found = pii.all_spans(text, pii.SemiMarkov())
    assert len(found) == 160_000 and all(x["base"] for x in found)
    assert sum(len(w[3]) for w in pii.windows(text)) == 160_000 and time.time() - began < 60


def test_pii_query_against_the_patterns(spark):
    """Every column of op4 but the added spans, by patterns alone; added spans overlap no other."""
    from test_operators import plain_spans

    documents = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r for r in pii.op4_pii(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(documents)
    for i, text in documents.items():
        base, r = plain_spans(text), got[i]
        assert [getattr(r, f"n_{k}") for k in pii.KINDS] == [sum(x[2] == k for x in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        every = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        added = sorted(set(every) - set(base))
        assert set(base) <= set(every) and len(added) == r.n_added and len(every) == len(base) + len(added)
        assert not any(s < y and x < e for s, e, _ in added for x, y, k in every if (x, y, k) != (s, e, _))
