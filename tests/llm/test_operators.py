"""Operators against brute force on small tables with nulls, ties, repeated rows and other columns."""

import itertools
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from weftline.llm import components, embedding_dedup, exact_dedup, html_text, language_model, mixing, ngram_join, packing, pii, quality, textkit, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, h string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    out = [(None, "no id here at all", "a"), (1, None, None), (2, "", "a"), (3, " \t\n", "b"), (4, "one two", "b"), (5, "ONE  two", "c"), (6, "x" * 20_000, "c"), (7, "rep", "a"), (7, "rep", "a")]
    for k in range(30):
        base = [rnd.choice(words) for _ in range(rnd.randint(6, 120))]
        for j in range(rnd.randint(1, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append((100 + 10 * k + j, " ".join(copy), rnd.choice("abc")))
    out.append((90_000, " ".join(rnd.choice(words) for _ in range(30_000)), "b"))
    return out


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def linked_components(rows):
    """{doc_id: (set size, smallest doc_id reachable by links)} of (doc_id, text, ...), by all pairs."""
    sets = {}
    for i, t, *_ in rows:
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    root = {i: i for i in sets if i is not None}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(root, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in root}


def test_ngram_join(spark, rows):
    got = ngram_join.similar_documents(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id} == linked_components(rows)


def test_ngram_join_at_places_of_two_sets(spark):
    """A set that meets one pivot at one place and another pivot at another place, and links with one of them alone."""
    given = []
    for k in range(120):
        n = [f"w{k}x{j}" for j in range(13)]
        texts = [n, [*n[:12], f"last{k}"], [*(f"other{k}x{j}" for j in range(8)), *n[8:]]]
        given += [(3 * k + j, " ".join(texts[(j + k) % 3]), "a") for j in range(3)]
    expected = linked_components(given)
    assert sum(i != c for i, (_, c) in expected.items()) == 120
    got = ngram_join.similar_documents(table(spark, given)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_at_many_small_places(spark, seed):
    """Texts of the ends and middles of a few others, so that sets meet two to four others at several places each."""
    rnd = random.Random(seed)
    given = []
    for k in range(60):
        bases = [[f"w{k}b{b}x{j}" for j in range(rnd.randint(12, 30))] for b in range(3)]
        for _ in range(rnd.randint(3, 6)):
            text = list(rnd.choice(bases))
            for _ in range(rnd.randint(0, 2)):
                text[rnd.choice((0, 1, -1, -2))] = f"new{rnd.randrange(3)}"
            if rnd.random() < 0.4:
                text += rnd.choice(bases)[-rnd.randint(5, 7) :]
            if rnd.random() < 0.3:
                text = rnd.choice(bases)[: rnd.randint(5, 6)] + text
            given.append((len(given), " ".join(text), "a"))
    rnd.shuffle(given)
    got = ngram_join.similar_documents(table(spark, given)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked_components(given)


def test_ngram_join_of_a_block_of_few_words(spark):
    got = ngram_join.similar_documents(table(spark, [(1, "a b c", "a")])).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(1, 1, 1)]
    for n in range(8):
        [block] = textkit.blocks(pa.array([" ".join("abcdefgh"[:n])]))
        assert [len(x) for x in ngram_join.shingle_sets(block)] == [max(n - 4, min(n, 1))]


def test_ngram_join_tells_texts_with_one_id_apart(spark):
    base = [[f"{c}{k}" for k in range(60)] for c in "abc"]
    near = lambda words: " ".join(["new", *words[1:]])
    given = [(7, " ".join(x)) for x in base] + [(3 + k, near(x)) for k, x in enumerate(base[:2])] + [(7, "alone " * 9)]
    docs = table(spark, [(i, t, "a") for i, t in given]).repartition(1)
    got = ngram_join.similar_documents(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(3, 56, 3), (4, 56, 4), (7, 1, 7), (7, 56, 3), (7, 56, 4), (7, 56, 7)]
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([*given[3:], given[2]])


def test_ngram_join_map_of_shared_keys_is_as_large_as_the_table_needs(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(4000)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(150)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + [f"{t} more" for t in texts[::3]])], "doc_id long, text string")
    rows = ngram_join.profiles(docs, np.zeros(0, np.uint64)).persist()
    bits = ngram_join.shared_keys_map(rows)
    assert len(bits) < 1 << 17
    met = {r.key for r in ngram_join.meetings(rows, bits).select("key").distinct().collect()}
    sets = Counter(k for keys in {tuple(r["keys"]) for r in rows.select("keys").collect()} for k in keys)
    shared = {k for k, n in sets.items() if n > 1}
    assert shared and shared <= met and len(met) < len(sets) / 2
    rows.unpersist()


def test_count_tree_finds_what_a_scan_finds():
    rnd = np.random.default_rng(1)
    points = rnd.poisson(0.6, (700, ngram_join.GROUPS)).astype(np.int64)
    points[350:] = points[:350] + rnd.poisson(0.02, (350, ngram_join.GROUPS))
    tree = ngram_join.CountTree(points)
    for q in points[::50]:
        both, sizes = np.minimum(points, q).sum(1), points.sum(1) + q.sum()
        assert set(np.flatnonzero(180 * both >= 80 * sizes)) == set(tree.reaching(q))


def test_count_vectors_bound_the_overlap_of_sets_of_any_size():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 3, 146, 400, 5000):
        x = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        others = [np.unique(np.concatenate((x[: int(n * share)], rnd.integers(0, 1 << 63, n - int(n * share), dtype=np.uint64)))) for share in (1, 0.9, 0.89, 0.5, 0)]
        for y in others:
            u, v = ngram_join.count_vector(x), ngram_join.count_vector(y)
            assert u.sum(dtype=int) == len(x) and np.minimum(ngram_join.fold(u, 64), ngram_join.fold(v, 64)).sum() >= len(np.intersect1d(x, y))
            if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)):
                assert ngram_join.may_link(u, v)
    # One group would pass a byte: more groups are taken.
    crowded = np.arange(1, 601, dtype=np.uint64) << np.uint64(10)
    vec = ngram_join.count_vector(crowded)
    assert vec.sum(dtype=int) == 600 and vec.max() < 256


@pytest.mark.parametrize("run, sql", [(exact_dedup.exact_groups, exact_dedup.ORACLE), (lambda d: mixing.mix(d).drop("h"), mixing.ORACLE)])
@pytest.mark.parametrize("empty", [False, True])
def test_native_operators_equal_sql(spark, rows, run, sql, empty):
    given = [] if empty else rows
    documents = pd.DataFrame([(i, t, s) for i, t, s in given], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64", "text": "string", "source": "string"})
    con = duckdb.connect()
    con.register("documents", documents)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else v
    want = sorted(repr(tuple(map(show, r))) for r in cursor.fetchall())
    assert want == sorted(repr(tuple(show(r[c]) for c in names)) for r in run(table(spark, given)).collect())


def test_mixed_rows_and_keep_one_have_the_columns_of_documents(spark, rows):
    docs = table(spark, rows)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == docs.select(docs.text).fillna("").distinct().count()
    taken = mixing.mix(docs).groupBy().sum("repeats").first()[0]
    assert mixing.mixed_rows(docs).where("length(trim(coalesce(text, ''))) > 3").count() <= taken


def test_packing_round_trip(spark, rows):
    encode = packing.encoder()
    got = packing.pack(table(spark, rows)).toPandas()
    assert got.sequence_id.is_unique and (got.offset == 0).all() and (got.length == 2**got.bucket).all() and got.length.max() <= 2048
    for i, t, _ in rows:
        if i is not None and i != 7:
            mine = got[got.doc_id == i].sort_values("start")
            ids = np.concatenate(mine.ids.tolist())
            assert ids.tolist() == [*encode(t or ""), 1] and (mine.doc_tokens == len(ids)).all()
            assert [zlib.crc32(np.asarray(x, "<u4").tobytes()) for x in mine.ids] == mine.ids_crc32.tolist()


def test_special_token_is_read_as_tokenizers_does():
    assert packing.encoder()("a<|endoftext|>b") == [64, 50256, 65]


def test_long_runs_of_white_space_are_packed(spark):
    text = "x" + " " * 1_200_000 + "y"
    got = packing.pack(table(spark, [(1, text, "a")])).collect()
    assert sum(r.length for r in got) == got[0].doc_tokens == len(packing.encoder()(text)) + 1


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 12 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda x: (x[0], pii.KINDS.index(x[2])))


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice("1234.+-@a ()0") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 100_000 + "a@" * 20_000 + "." * 50_000) == []


def test_semi_markov_adds_what_patterns_miss(spark):
    texts = [f"call +1 ({n}) 555-{n + 1000} or bob.{n}@mail.example.com at 10.{n % 250}.3.4 now" for n in range(200, 260)] + [None, ""]
    docs = table(spark, [(k, t, "a") for k, t in enumerate(texts)] + [(500, "ring (988) 555-2485 today", "a")])
    got = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find_pii(docs).collect()}
    assert got[500] == [("phone", False)] and got[60] == got[61] == []
    assert got[0] == [("phone", True), ("email", True), ("ip", True)]


def test_semi_markov_has_candidates_for_long_written_forms():
    texts = [f"call +1 ({n}) 555-{n + 1000} or bob.{n}@mail.example.com at 10.{n % 250}.3.4 now" for n in range(200, 260)]
    model = pii.SemiMarkov().fit(pii.training_cases(texts))
    for long in ("user (at) mail (dot) example (dot) com", "john.m.doe (at) example (dot) com", "j.m.doe [at] mail [dot] example [dot] com"):
        text = f"write to {long} today"
        assert [(text[s["start"] : s["end"]], s["kind"], s["base"]) for s in pii.all_spans(text, model)] == [(long, "email", False)]
    for long in ("9 8 8 5 5 5 2 4 8 5", "(9 8 8) 5 5 5 - 2 4 8 5", " - ".join("9885552485123456789"), "+(" + "1.-." * 18 + "1"):
        text = f"ring {long} today"
        [(a, b)] = pii.regions(text)
        bounds, by_end = model.lattice(text, a, b)
        assert text[a:b] == long and any(i == 0 and kind == "phone" for i, kind, _ in by_end[-1])
    assert not any(model.lattice("1" * 20, 0, 20)[1])


def test_fitted_operators(spark):
    rnd = random.Random(5)
    bad = lambda k: k % 3 == 0
    texts = [" ".join(rnd.choice(["the", "of", "and", f"x{rnd.randrange(50)}"]) for _ in range(60)) + (" idiot scum" if bad(k) else "") for k in range(150)]
    low = [t.upper().replace(" ", "!! ") if k % 5 == 0 else t for k, t in enumerate(texts)]
    docs = table(spark, [(k, t, "a") for k, t in enumerate(low)] + [(900, None, None), (901, "", "b")])
    labels = spark.createDataFrame([(k, int(k % 5 != 0), int(bad(k))) for k in range(150)] + [(None, 1, 1), (3000, None, None)], "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert all((r.p_toxic >= 0.5) == bad(r.doc_id) for r in found if r.doc_id < 150) and found[0].asDict()["digest"] == "x"
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {900, 901} <= {r.doc_id for r in kept.collect()}
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert np.mean([(scores[k] > 0.5) == (k % 5 != 0) for k in range(150)]) > 0.95 and 0 <= scores[900] <= 1
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_embeddings(spark):
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(20, 16))
    x = np.repeat(base, 6, axis=0) + rnd.normal(size=(120, 16)) * rnd.choice([0, 0.05, 0.3], size=(120, 1))
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [1.0] * 15 + [None]), (1003, [1.0] * 15 + [float("nan")]), (1004, [1.0] * 3)]
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + [(i, v, 0) for i, v in odd], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(120)
    for _ in range(120):
        label = np.array([min([label[i], *label[near[i]]]) for i in range(120)])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(vectors).collect()}
    assert got == {i: (int(near[i].sum()), int(label[i]), bool(label[i] == i)) for i in range(120)} | {i: (0, i, True) for i, _ in odd}
    assert embedding_dedup.near_vectors(vectors.limit(0)).count() == 0


def test_embeddings_of_several_lengths(spark):
    rare = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 2.0, 3.1]), (4, [3.0, -2.0, 1.0]), (5, [2.0]), (6, [0.5]), (7, [-1.0]), (8, [0.0, 1.0])]
    common = [(100 + k, np.eye(8)[k % 8].tolist()) for k in range(16)]
    vectors = spark.createDataFrame(rare + common, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(vectors).collect()}
    want = {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (0, 4, True), 5: (1, 5, True), 6: (1, 5, False), 7: (0, 7, True), 8: (0, 8, True)}
    assert got == want | {100 + k: (1, 100 + k % 8, k < 8) for k in range(16)}


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 102), (102, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in (100, 101, 102)}


def test_language_model_equals_brute_force(spark, rows):
    docs, depth = table(spark, rows), 3
    train = [r for r in rows if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10]
    plain = lambda t: " ".join(words_of(t)).encode() + b"\n"
    code = lambda x, k: sum((x[k - d] if k >= d else 10) << 8 * (depth - d) for d in range(depth + 1))
    seen, every = Counter(), {code(x, k) for _, t, _ in rows for x in [plain(t)] for k in range(len(x))}
    for _, t, _ in train:
        x = plain(t)
        seen.update(code(x, k) for k in range(len(x)))
    codes = np.array(sorted(every), np.uint64)
    logs = dict(zip(sorted(every), language_model.tree_log10(codes, np.array([seen[c] for c in sorted(every)]), depth)))
    words = Counter(w for _, t, _ in train for w in [*words_of(t), None])
    n = sum(words.values())
    want = []
    for i, t, _ in rows:
        x, mine = plain(t), [*words_of(t), None]
        base = sum(np.log10((words[w] + 0.1) / (n + 0.1 * (len(words) + 1))) for w in mine)
        want.append((str(i), len(mine), sum(words[w] > 0 for w in mine), n, base, sum(logs[code(x, k)] for k in range(len(x)))))
    for block_bytes in (20_000, 1 << 25):
        got = language_model.score(docs, depth, block_bytes).collect()
        got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
        assert [g[:4] for g in got] == [w[:4] for w in sorted(want)]
        assert np.allclose([g[4:] for g in got], [w[4:] for w in sorted(want)], rtol=1e-9)
    assert language_model.score(docs.limit(0)).count() == 0


def test_language_model_without_training_documents(spark):
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    got = language_model.score(table(spark, [(k, t, "a") for k, t in zip(held, ("a b", "", None))])).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert all(abs(r.score - 8 * np.log10(0.5) * size) < 1e-9 for r, size in zip(sorted(got, key=lambda r: r.doc_id), (4, 1, 1)))


def test_whole_groups_split_no_part(monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK", 50)
    part = np.sort(np.random.default_rng(3).integers(0, 9, 1000) ** 2 // 9)
    tables = list(language_model.whole_groups(iter(pa.table({"part": part}).to_batches(max_chunksize=30))))
    assert np.concatenate([t["part"].to_numpy() for t in tables]).tolist() == part.tolist()
    ends = [set(t["part"].to_pylist()) for t in tables]
    assert len(tables) > 3 and sum(map(len, ends)) == len(set(part.tolist()))
    assert list(language_model.whole_groups(iter([]))) == []


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5])
def test_tree_by_layers_equals_the_tree_in_one_place(spark, depth):
    rnd = np.random.default_rng(depth)
    given = np.zeros(3000, np.uint64)
    for _ in range(depth + 1):
        given = given << np.uint64(8) | rnd.choice([10, 32, 101, 116, 255], 3000, p=[0.1, 0.3, 0.3, 0.2, 0.1]).astype(np.uint64)
    codes, counts = np.unique(given, return_counts=True)
    counts[::7] = 0
    found = language_model.tree(spark.createDataFrame([(int(c), int(n)) for c, n in zip(codes, counts)], "item long, n long"), depth)
    got = {r.item: r.value for r in found.collect()}
    assert np.allclose([got[int(c)] for c in codes], language_model.tree_log10(codes, counts, depth), rtol=1e-9)


def test_table_finds_keys_and_only_keys():
    rnd = np.random.default_rng(6)
    for n in (0, 1, 5, 20_000):
        keys = np.unique(np.concatenate((rnd.integers(0, 1 << 63, n, dtype=np.uint64), np.arange(min(n, 3), dtype=np.uint64))))
        asked = np.concatenate((keys, rnd.integers(0, 1 << 63, 999, dtype=np.uint64), np.arange(9, dtype=np.uint64)))
        values = rnd.random(len(keys))
        known = dict(zip(keys.tolist(), values))
        assert language_model.Table(keys, values, -1.0).get(asked).tolist() == [known.get(k, -1.0) for k in asked.tolist()]


def test_table_of_a_block_takes_few_bytes_a_key():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 62, 1_100_000).astype(np.uint64))
    values = keys.astype(float)
    table = language_model.Table(keys, values, -1.0)
    assert sum(x.nbytes for x in (table.keys, table.values, table.lost, table.lost_values)) < 40 * len(keys)
    assert (table.get(keys) == values).all()


def test_context_tree_is_a_distribution():
    rnd = np.random.default_rng(4)
    context = rnd.integers(0, 3, (500, 2)).astype(np.uint64)
    byte = rnd.integers(0, 256, 500).astype(np.uint64)
    seen, n = np.unique(byte << np.uint64(16) | context[:, 0] << np.uint64(8) | context[:, 1], return_counts=True)
    every = np.array([b << 16 | x << 8 | y for b in range(256) for x in range(3) for y in range(3)], np.uint64)
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, seen)] = n
    p = 10 ** language_model.tree_log10(every, counts, 2)
    assert np.allclose(p.reshape(256, -1).sum(0), 1)


def test_html():
    page = "<!doctype html><html><head><title>t</title><style>p{}</style></head><body><h1>Head</h1><p>One <b>two</b>\n three<p>Four<br>five<script>var a='</p>'</script><ul><li>a<li>b<ol start=3><li>c</ol></ul><div hidden>no</div><p style='display: none'>no</p><table><tr><th>Name<th>N<tr><td>Longer name<td>12</table><pre> x\n  y</pre>&copy; end"
    want = "Head\n\nOne two three\n\nFour\nfive\n\n- a\n- b\n  3. c\n\nName         N\nLonger name  12\n\n x\n  y\n\n© end"
    assert html_text.visible_text(page) == want
    assert html_text.visible_text(None) is None and html_text.visible_text("") == "" and html_text.visible_text("<div>" * 20_000 + "x") == "x"


@pytest.mark.parametrize("start", ["<p>Hello", "Hello", "<div>Hello</div>", "<body><p>Hello", "</head>Hello", "&lt;!-- x<!-- y -->", "< 5", "<custom-tag>Hello"])
def test_html_head_without_end(start):
    head = "<!doctype html>\n<html>\n<head> <meta charset=utf-8>\n<title>t</title><link rel=x><template><p>no</template><noscript>no</noscript><style>p{}</style>\n<!-- no --> "
    seen = html_text.visible_text(head + start + "<p>and <b>more")
    assert seen.split("\n\n") == [re.sub("<!--.*?-->|</?[a-z].*?>", "", start).replace("&lt;", "<"), "and more"]
    assert html_text.visible_text(head) == "" and html_text.visible_text("<head><head><p>a<head>b") == "ab"


def test_html_tables_keep_their_columns(monkeypatch):
    page = "<table><thead><tr><th rowspan=5>H<th>I</thead><tr><td rowspan=2>a<td>b<td rowspan=0 colspan=2>c<td>d<tr><td>e<td>f<tr><td>g<td>h<td>i</table>"
    assert html_text.visible_text(page) == "H  I\na  b  c    d\n   e       f\ng  h       i"
    long = "x" * 300
    page = f"<table><tr><td>{long}<td>b<td>c<tr><td>a<td>bb<td>c</table>"
    assert html_text.visible_text(page) == f"{long}  b   c\n{'a'.ljust(300)}  bb  c"
    monkeypatch.setattr(html_text, "PADDED", 500)
    assert html_text.visible_text(page) == f"{long}  b   c\n{'a'.ljust(200)}  bb  c"
    monkeypatch.setattr(html_text, "PADDED", 300)
    assert html_text.visible_text(page) == f"{long}  b  c\na  bb  c"


def test_html_forms_and_drawings():
    form = "<p>Say <textarea rows=2>\none <b> &amp;\n  two</textarea> or <select><optgroup><option>red<option selected>blue</optgroup></select> now<datalist><option>no</datalist>"
    assert html_text.visible_text(form) == "Say\none <b> &\n  two\nor\nred\nblue\nnow"
    svg = "<p>Plot<svg viewBox='0 0 9 9'><title/><title>no</title><defs><text>no</text></defs><g/>no<text x=1>Q1 <tspan>sales</tspan></text><desc>no</desc><style/><path d=M0/><text>Q2<title>no</title></text><foreignObject><div>in <b>html</b></div></foreignObject></svg> end"
    assert html_text.visible_text(svg) == "Plot\nQ1 sales\nQ2\nin html\nend"
    assert html_text.visible_text("<svg/>a<text>b</text><defs>c</defs><textarea hidden>no</textarea>") == "abc"


def test_html_of_deep_and_odd_trees():
    see = html_text.visible_text
    assert see("<ul><li>" + "<b>" * 600 + "one<li>two</ul>") == "- one\n- two"
    assert see("<p>" + "<i>" * 9 + "t</p>u") == "t\n\nu" and see("a</p>b") == "a\n\nb" and see("a</br>b") == "a\nb"
    deep = see("<ul><li>a<br>b" * 40)
    assert deep.split("\n")[-2:] == [" " * 78 + "- a", " " * 80 + "b"]
    assert see("<ul><li>" * 20_000 + "x").endswith("- - x") and len(see("<ul><li>a" * 20_000)) < 80 << 20
    assert see("<ol start='12345678901'><li>a</ol><ol start=-3><li>a<li value=2147483647>b</ol>") == "1. a\n\n-3. a\n2147483647. b"
    assert see("<table><tr><td colspan=123456>a<td>b<tr><td>c</table>").startswith("a") and html_text._span("123456", 1000) == 1000
    assert see("<div style='visibility:hidden'>no<p style='visibility: visible'>yes <span style='visibility:hidden'>no</span>too</p>no<ul><li>no</ul></div>end") == "yes too\n\nend"
    assert see("<svg>" + "<g>" * 600 + "<text>t<tspan/>u</text></svg>v") == "tu\nv"


def test_html_cells_keep_their_blocks():
    page = "<table><tr><td><p>one<p>two<td>x<br>y<td><ul><li>a<li>b</ul><tr><td>three<td>z<td><table><tr><td>1<td>22<tr><td>333<td>4</table></table>"
    assert html_text.visible_text(page) == "one    x  - a\n       y  - b\ntwo\nthree  z  1    22\n          333  4"


def test_html_pages_made_at_random_show_all_visible_text(spark):
    """Trees of known text: each visible word comes once and in order, none of the others does."""
    rnd = random.Random(4)

    def made(depth, shown, words):
        if depth == 0 or rnd.random() < 0.3:
            words.append((f"w{len(words)}", shown))
            return words[-1][0] + " "
        tag = rnd.choice(["div", "p", "b", "ul", "table", "section", "script", "template", "span hidden", "i style='display:none'", "h2", "blockquote"])
        own = shown and not tag.startswith(("script", "template", "span h", "i s"))
        inner = "".join(made(depth - 1, own, words) for _ in range(rnd.randint(1, 3))) if tag not in ("script", "p") else made(0, own, words)
        if tag == "ul":
            inner = f"<li>{inner}"
        elif tag == "table":
            inner = f"<tr><td>{inner}"
        name = tag.split()[0]
        return f"<{tag}>{inner}" + f"</{name}>"

    pages, want = [], []
    for _ in range(300):
        words = []
        pages.append(f"<html><head><title>no</title><body>{made(5, True, words)}")
        want.append([w for w, shown in words if shown])
    rows = [(k, f"u{k}", p) for k, p in enumerate(pages)] + [(None, None, None), (5, "u5", pages[5]), (900, "", "")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text is None if r.page_id is None else sorted(re.findall(r"w\d+", r.text)) == sorted(want[r.page_id] if r.page_id < 900 else [])
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_language_model_equals_the_ratio_of_whole_tree_probabilities():
    """Context-tree weighting with its recursion written out, on trees of plain tuples, at depth 2."""
    from fractions import Fraction

    train, seen = [b"abab\n", b"aab b\n", b"\n"], b"abb\n"

    def bits(texts):
        for x in texts:
            for k, byte in enumerate(x):
                context = tuple(x[k - d] if k >= d else 10 for d in (1, 2))
                for i in range(8):
                    yield (1 << i) | byte >> (8 - i), context, byte >> (7 - i) & 1

    def estimate(zeros, ones):
        p = Fraction(1)
        for k in range(zeros):
            p *= Fraction(2 * k + 1, 2 * (k + 1))
        for k in range(ones):
            p *= Fraction(2 * k + 1, 2 * (zeros + k + 1))
        return p

    def weighted(rows, depth):
        own = estimate(sum(b == 0 for _, b in rows), sum(b == 1 for _, b in rows))
        if depth == 2:
            return own
        below = Fraction(1)
        for value in {c[depth] for c, _ in rows}:
            below *= weighted([(c, b) for c, b in rows if c[depth] == value], depth + 1)
        return (own + below) / 2

    trees = {}
    for prefix, context, bit in bits(train):
        trees.setdefault(prefix, []).append((context, bit))
    want = 1.0
    for prefix, context, bit in bits([seen]):
        rows = trees.get(prefix, [])
        want *= float(weighted([*rows, (context, bit)], 0) / weighted(rows, 0))
    code = lambda x, k: sum((x[k - d] if k >= d else 10) << 8 * (2 - d) for d in range(3))
    counts = Counter(code(x, k) for x in train for k in range(len(x)))
    codes = sorted({*counts, *(code(seen, k) for k in range(len(seen)))})
    logs = dict(zip(codes, language_model.tree_log10(np.array(codes, np.uint64), np.array([counts[c] for c in codes]), 2)))
    assert np.isclose(sum(logs[code(seen, k)] for k in range(len(seen))), np.log10(want), rtol=1e-9)


def test_the_last_display_counts():
    shown = lambda style, more="": html_text.visible_text(f"<p>a<div {more} style='{style}'>x</div>b")
    for style, more, seen in [("display:none;display:block", "", True), ("display:block;display:none", "", False), ("display:none", "", False), ("display:none !important;display:block", "", False), ("display:none;display:wrong", "", False), ("display:block", "hidden", True), ("color:red", "hidden", False), ("x-display:none", "", True)]:
        assert ("x" in shown(style, more)) == seen, style


def test_distinct_strings_cost_about_a_sort():
    """numpy's own `unique` hashes integers since 2.3, ten times as slow, and took a quarter of operator 9's time."""
    items = np.random.default_rng(9).integers(0, 1 << 40, 150_000, dtype=np.uint64)[np.random.default_rng(8).integers(0, 150_000, 1 << 19)]

    def seconds(work):
        took = []
        for _ in range(5):
            began = time.perf_counter()
            work()
            took.append(time.perf_counter() - began)
        return min(took)

    assert language_model.distinct_of([items[:1000], items]).tolist() == sorted(set(items.tolist())) and language_model.distinct_of([]).tolist() == []
    assert seconds(lambda: language_model.distinct_of([items])) < 4 * seconds(lambda: np.sort(items))
