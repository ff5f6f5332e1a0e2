"""Operators 11 to 13 against plain versions, on odd rows and on whole tables by their queries."""

import hashlib
import re
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import fill_in_middle, token_alignment, token_files

public = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
CLASHING = "row, h, at, block, number, ids, groups, kind, best, times, n, form, output, start"
TEXTS = [
    None, "", " ", "a", "some words, and more of them.", "Some words and\u0085more", "é é ñ Ñ ǅ İ ß ΑΣ Σ", "tabs\tand\x0blines\r\nand\x0cfeeds\n", "\x1c\x1d\x1e\x1f\x00 control", "a<|endoftext|>b <|startoftext|>c<|endoftext|>",
    "▁ is a space to B", "日本語のテキスト 中文 한국어", "👩‍👩‍👧 emoji 🏳️‍🌈", "<P>", "x <S y< z <", "text with <M> in it", "don't we'll I'D 12345 67,890.12", "a" * 5000, " " * 3000 + "x" + "\n" * 3000, ("word " * 30_000).strip(), "﻿bom", "same text", "same text",
]
ROWS = [(k if k != 4 else None, t) for k, t in enumerate(TEXTS)] + [(7, TEXTS[7]), (7, TEXTS[7]), (7, "another text of the same id"), (10**12, "a far id"), (-5, "a low id")]


def table(spark, rows):
    names = CLASHING.split(", ")
    return spark.createDataFrame([(*r, *names) for r in rows], f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}").repartition(3)


def documents(spark):
    path = f"{SF}/documents.parquet"
    return [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]


def test_fill_in_middle_equals_sql(spark):
    got = sorted(repr(tuple(r)) for r in fill_in_middle.op11_fill_in_middle(spark, SF).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(map(repr, con.execute(fill_in_middle.ORACLE).fetchall()))


def plain_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_of_odd_rows(spark):
    rows = ROWS + [(100 + k, f"{'< ' * (k % 3)}<P <S{k} <M <" + " word" * k) for k in range(60)]
    made = fill_in_middle.fill_in_middle(table(spark, rows)).withColumn("text", fill_in_middle.restored()).collect()
    want = sorted(((i, *plain_fill(i, t), t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in made), key=repr) == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(table(spark, [])).collect() == []


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_units_do_not_depend_on_chunks(chunk):
    for text in filter(None, TEXTS):
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        assert fill_in_middle.unit_ends(text[:9000], chunk).tolist() == np.cumsum([len(u) for u in re.findall(fill_in_middle.UNIT, text[:9000])]).tolist()
        assert len(fill_in_middle.unit_ends(text)) == len(units)


@pytest.fixture(scope="module")
def word_ids():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, 1]


def encoded(known, texts):
    return [np.frombuffer(x, known.dtype).tolist() for x in known.encode([(t or "").encode() for t in texts])]


def test_words_give_the_ids_of_whole_texts(spark, word_ids):
    texts = [t for _, t in [*ROWS, *documents(spark)]]
    assert encoded(token_files.WordEncoder(), texts) == [word_ids(t)[:-1] for t in texts]


def test_an_encoder_that_forgets_gives_the_same_ids(word_ids, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 6)
    monkeypatch.setattr(token_files, "ASKED", 3)
    known = token_files.WordEncoder()
    for k in range(200):
        text = f"word{k % 7} W{k}. it's?! ({k})."
        assert encoded(known, [text, text]) == [word_ids(text)[:-1]] * 2 and len(known.known) <= 14


def test_words_with_stops_and_capitals(word_ids):
    known, parts = token_files.WordEncoder(), ["It's", "'S", "<|ENDOFTEXT|>", "<|endoftext|>", "a", "Z9", ".", "?!", "'", ")", "É", "İ", "I\u0307", "e\u0301", "_", "-", "\u00a0", "¡", "ﬁ", "\u0301", "\u0085"]
    texts = [f"{x}{y}{z} {z}{y}{x}" for x in parts for y in parts for z in ("", ".", "...", "'.", ",'", "’s,")]
    assert encoded(known, texts) == [word_ids(t)[:-1] for t in texts]


@pytest.mark.parametrize("length, rows, file_bytes", [(8, 3, 4000), (2048, 64, 64 << 20)])
def test_token_files(spark, word_ids, tmp_path, length, rows, file_bytes):
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    files = token_files.write_token_files(table(spark, ROWS), folder, length=length, rows=rows, file_bytes=file_bytes).orderBy("part").collect()
    assert len(files) > 3 or file_bytes > 4000
    got = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id) for r in got] == sorted(((i is not None, i) for i, _ in ROWS), key=lambda x: (x[0], x[1] or 0))
    at, texts = 0, defaultdict(list)
    for i, t in ROWS:
        texts[i].append(word_ids(t))
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids)) and r.ids in texts[r.doc_id]
        texts[r.doc_id].remove(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    # Every sequence of every file, in any order: the stream, and a mask that leaves out the padding of the last one.
    stream = []
    for f in files:
        with token_files.opened(f"{folder}/{f.ids}") as source:
            seen = token_files.SequenceFile(source)
            parts = {k: seen.sequence(k) for k in reversed(range(f.n_sequences))}
            assert {len(x) for pair in parts.values() for x in pair} == {length}
            for k in range(f.n_sequences):
                ids, mask = (x.to_pylist() for x in parts[k])
                assert mask == sorted(mask, reverse=True) and (k == f.n_sequences - 1 or all(mask))
                stream += [i for i, m in zip(ids, mask) if m]
        assert len(stream) == f.base + f.n_ids
    assert stream == [i for r in got for i in r.ids]


def test_sequences_of_a_memory_map_are_not_copied(spark, tmp_path):
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    [f] = token_files.write_token_files(table(spark, ROWS), folder, length=16, rows=4).collect()
    before = pa.total_allocated_bytes()
    with token_files.opened(f"{folder}/{f.ids}") as source:
        seen = token_files.SequenceFile(source)
        kept = [seen.sequence(k) for k in range(f.n_sequences)]
        assert pa.total_allocated_bytes() == before and len(kept) == f.n_sequences > 1000


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    assert token_files.write_token_files(table(spark, []), folder).count() == 0
    assert token_files.read_documents(spark, folder).count() == 0


def test_token_files_query(spark, word_ids):
    want, at = [], 0
    for i, t in sorted(documents(spark)):
        ids = word_ids(t)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = token_files.op12_token_files(spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == want


def plain_alignment(rows):
    """{row number: (doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum)} by walking along both lists of tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = [(i, bytes(back[c] for c in a_side.id_to_token(i))) for i in a_side.encode(f" {text}", add_special_tokens=False).ids] if text else []
        b = [(i, bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()) for i in b_side.encode(text or "")]
        raw = f" {text}".encode()
        if not text or any(b"".join(t for _, t in side) != raw for side in (a, b)):
            found.append((doc_id, [], [], [], []))
            continue
        links, groups, i, j = [], [([], [])], 0, 0
        ends = [[*np.cumsum([len(t) for _, t in side])] for side in (a, b)]
        while i < len(a):
            links.append((a[i][0], b[j][0]))
            low = min(ends[0][i], ends[1][j])
            step = [ends[0][i] == low, ends[1][j] == low]
            for side, (tokens, k) in enumerate(((a, i), (b, j))):
                if step[side]:
                    groups[-1][side].append(tokens[k][0])
            if all(step):
                groups.append(([], []))
            i, j = i + step[0], j + step[1]
        counts.update(links)
        found.append((doc_id, a, b, groups[:-1], links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    notation = lambda groups: ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
    return [(i, len(a), len(b), len(g), len(x), notation(g), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x)) for i, a, b, g, x in found]


@pytest.mark.parametrize("block", [1, 2000, 16 << 20])
def test_alignment_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_alignment, "PAIRS", 50)
    got = token_alignment.alignment(table(spark, ROWS))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    want = plain_alignment(ROWS)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert [w[1] for w in want[:2]] == [0, 0] and want[10][1] == 0 and all(w[1] for w in want[15:])


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.alignment(table(spark, [])).collect() == []
    assert sorted(r.n_a for r in token_alignment.alignment(table(spark, [(1, None), (1, ""), (None, None)])).collect()) == [0, 0, 0]


def test_alignment_query(spark):
    want = [(*w[:5], hashlib.sha256(w[5].encode()).hexdigest() if w[5] else "", *w[6:]) for w in plain_alignment(documents(spark))]
    got = token_alignment.op13_token_alignment(spark, SF)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want)


def test_packed_numbers_come_back():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 10, 70_000):
        given = rnd.integers(0, 1 << 20, n)
        u, times = token_alignment.unpacked(token_alignment.packed(given))
        v, n_of = np.unique(given, return_counts=True)
        assert (u == v).all() and (times == n_of).all()


def test_long_runs_of_white_space_are_aligned():
    own = token_alignment.aligner()
    for text in ("x" + " " * 1_200_000 + "y", "\n" * 250_000):
        found = own.encode(text)
        assert found is not None and b"".join(own.bytes[0][found[0]].tolist()) == f" {text}".encode()
