"""Cross-tokenizer alignment by per-byte labels (operator 13).

Each byte of a text has a label: no token ends there, one of tokenizer A does, one
of B, or one of both. A regular expression scans the string of labels for spans up
to each both-label, and the labels counted in a span say how many tokens of A and
of B its group has. Between two neighbouring ends lies one pair of tokens that
overlap: a link.

How often an id pair is linked in the corpus is asked for by blocks of documents.
A task cuts what it reads into blocks and lists each block's distinct pairs once,
numbered from the most frequent down; documents keep their links as numbers of
that list. Sums over all blocks, and the highest sum of each B id, are joined to
the lists, and answers meet the documents of their block in a stream.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import textkit
from weftline.llm.common import join_to_classes, materialize, read_table, release

#: Bytes of text in a block (one longer text is a block of its own), and pairs in a row of its list.
BLOCK_BYTES, PAIRS = 8 << 20, 1 << 14
#: Labels of a byte.
NONE, A_END, B_END, BOTH = 0, 1, 2, 3
_SPAN = re.compile(b"[^\x03]*\x03")
_LOW = (1 << 32) - 1


class Aligner:
    """The two tokenizers, the bytes of their tokens, and groups and links of one text."""

    def __init__(self, a_json: str | None = None, a_ranks: str | None = None, b_model: str | None = None):
        import public_tokenizers as public
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        self.a_json = a_json or public.path("byte_bpe_50k.json")
        with open(a_ranks or public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # The vocabulary of a_json with the same pattern: equal ids, and no string is special.
        self.a = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b_model or public.path("piece_bpe_32k.model"))
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a_bytes[rank] = token
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.bytes = [np.array(x, object) for x in (a_bytes, b_bytes)]
        self.lengths = [np.array([len(t) for t in x]) for x in (a_bytes, b_bytes)]
        #: Decimal ids with what follows them: another token, the other side, the next group.
        self.written = np.array([f"{i}{sign}" for i in range(max(map(len, (a_bytes, b_bytes)))) for sign in ",|;"], object)

    @property
    def slow(self):
        if "_slow" not in self.__dict__:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.a_json)
            self._slow.encode_special_tokens = True  # their strings in a text are ordinary text
        return self._slow

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B; None where the bytes of the tokens aren't those of a space and the text."""
        if not text:
            return None
        spaced = f" {text}"
        if textkit.has_long_run(spaced):
            a = np.array(self.slow.encode(spaced, add_special_tokens=False).ids, np.int64)
        else:
            a = self.a.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        b = np.array(self.b.encode(text), np.int64)
        raw = spaced.encode()
        if any(b"".join(known[ids].tolist()) != raw for known, ids in zip(self.bytes, (a, b))):
            return None
        return a, b

    def labels(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a_ends, b_ends = (np.cumsum(known[ids]) for known, ids in zip(self.lengths, (a, b)))
        out = np.zeros(a_ends[-1], np.uint8)
        out[a_ends - 1] = A_END
        out[b_ends - 1] += B_END
        return out

    def groups(self, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of A and of B each group has: the labels of each side, counted from the end of one span to that of the next."""
        ends = np.cumsum(np.fromiter(map(len, _SPAN.findall(labels.tobytes())), np.int64))
        return tuple(np.diff(np.cumsum(labels & sign > 0)[ends - 1], prepend=0) for sign in (A_END, B_END))

    def notation(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> str:
        """a1,a2|b1;a3|b2,b3"""
        index = np.zeros(len(a) + len(b), np.int64)
        a_through, b_through = np.cumsum(n_a), np.cumsum(n_b)
        at = [np.arange(len(a)) + np.repeat(b_through - n_b, n_a), np.arange(len(b)) + np.repeat(a_through, n_b)]
        for ids, place in zip((a, b), at):
            index[place] = ids * 3
        index[at[0][a_through - 1]] += 1
        index[at[1][b_through - 1]] += 2
        return "".join(self.written[index].tolist())[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Each link's id pair in one number, A's id in the upper half: between two ends both tokens are those that end next."""
        ends = labels[labels > NONE]
        before = [np.cumsum(ends & sign > 0) - (ends & sign > 0) for sign in (A_END, B_END)]
        return a[before[0]] << 32 | b[before[1]]


@lru_cache(maxsize=1)
def aligner(a_json: str | None = None, a_ranks: str | None = None, b_model: str | None = None) -> Aligner:
    return Aligner(a_json, a_ranks, b_model)


def packed(numbers: np.ndarray) -> bytes:
    """A multiset of numbers: distinct ones as gaps, how often each comes, by planes of bytes, compressed."""
    u, n = np.unique(numbers, return_counts=True)
    planes = np.concatenate((np.diff(u, prepend=0), n)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(u).to_bytes(4, "little") + (pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(u) else b"")


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct numbers, how often each comes)."""
    n = int.from_bytes(data[:4], "little")
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[4:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    both = planes.reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, slots binary, first long, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, a_json: str | None = None, a_ranks: str | None = None, b_model: str | None = None) -> DataFrame:
    """Rows of two kinds. Kind 1, one per row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups (in the notation
    a1,a2|b1;a3|b2,b3), and its links as numbers of the block's list. Kind 0, parts of that list: the pairs from number `first` on and
    how often each is linked in the block.

    Null and empty texts, and those whose tokens don't give back a space and the
    text, have zeros and no groups. Repeated rows count each; other columns are not
    read; an empty table has no rows of either kind.
    """
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups", pa.string()), ("slots", pa.binary()), ("first", pa.int64()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def rows_of(kind: int, block: int, **columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        given = {"kind": [kind] * n, "block": [block] * n} | columns
        return pa.RecordBatch.from_arrays([pa.array(given.get(f.name, [None] * n), f.type) for f in schema], schema=schema)

    def block_rows(block: int, rows: list[tuple], links: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """First the list, then the documents a few MB of groups at a time."""
        every = np.concatenate([np.zeros(0, np.int64), *links])
        pairs, inverse, times = np.unique(every, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        slots, cut = number[inverse], np.cumsum([0, *map(len, links)])
        del every, inverse
        for k in range(0, len(order), PAIRS):
            part = order[k : k + PAIRS]
            yield rows_of(0, block, first=[k], pairs=[pairs[part]], times=[times[part]])
        at, held = 0, 0
        for k, row in enumerate(rows):
            held += len(row[-1])
            if held > 8 << 20 or k == len(rows) - 1:
                names = ("doc_id", *_COUNTS, "groups")
                packs = [packed(slots[cut[j] : cut[j + 1]]) for j in range(at, k + 1)]
                yield rows_of(1, block, **{name: [r[c] for r in rows[at : k + 1]] for c, name in enumerate(names)}, slots=packs)
                at, held = k + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(a_json, a_ranks, b_model), TaskContext.get().partitionId() << 32
        rows, links, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if held and held + len(text) > BLOCK_BYTES:
                    yield from block_rows(block, rows, links)
                    rows, links, held, block = [], [], 0, block + 1
                held += len(text)
                found = own.encode(text)
                if found is None:
                    rows.append((doc_id, 0, 0, 0, 0, ""))
                    links.append(np.zeros(0, np.int64))
                    continue
                a, b = found
                labels = own.labels(a, b)
                n_a, n_b = own.groups(labels)
                links.append(own.links(a, b, labels))
                rows.append((doc_id, len(a), len(b), len(n_a), len(links[-1]), own.notation(a, b, n_a, n_b)))
        if rows:
            yield from block_rows(block, rows, links)
        del rows, links
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def pair_counts(kept: DataFrame) -> DataFrame:
    """(pair, b, times, asks, best) of the rows of `aligned`: how often an id pair is linked in the corpus, in how many blocks, and whether
    no pair with its B id has more."""
    listed = kept.where("kind = 0").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("asks"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(_LOW))), "pair-counts")
    most = F.broadcast(counts.groupBy("b").agg(F.max("times").alias("most")))  # a row per id of B's vocabulary
    return counts.join(most, "b").select("pair", "b", "times", "asks", (F.col("times") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, digest: bool = False, **paths: str) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    count_sum adds up, over the links of a row, how often their id pairs are linked
    in all of `docs`; n_best counts the links whose pair has the most of its B id.
    With `digest` groups is the sha256 of the notation, '' without tokens. Empty
    and repeated rows: see `aligned`.
    """
    made = aligned(docs, **paths)
    if digest:
        made = made.withColumn("groups", F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.col("groups")))
    kept = materialize(made, "aligned")
    counts = materialize(pair_counts(kept), "pairs")
    asked = kept.where("kind = 0").select("block", "first", F.posexplode("pairs").alias("nth", "pair")).select("block", (F.col("first") + F.col("nth")).alias("number"), "pair")
    answers = join_to_classes(asked, counts.select("pair", "times", "best", "asks"), ["pair"], "asks", asked.count())
    nothing = {c: F.lit(None) for c in ("doc_id", *_COUNTS, "groups", "slots")}
    answers = answers.select(F.lit(0).alias("kind"), "block", *[v.alias(c) for c, v in nothing.items()], "number", "times", "best")
    rows = kept.where("kind = 1").select("kind", "block", *nothing, F.lit(None).alias("number"), F.lit(None).alias("times"), F.lit(None).alias("best"))
    met = answers.unionByName(rows).repartition("block").sortWithinPartitions("block", "kind", "number")
    return met.mapInArrow(_scored, f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups string, n_best long, count_sum long")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of rows in which a block's answers, in order of their numbers, come before its documents."""
    block, times, best, reading = None, [], [], False
    for batch in batches:
        kinds, blocks = batch["kind"].to_numpy(), batch["block"].to_numpy()
        cuts = [0, *(np.flatnonzero((kinds[1:] != kinds[:-1]) | (blocks[1:] != blocks[:-1])) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            part = batch.slice(start, stop - start)
            if blocks[start] != block:
                block, times, best, reading = blocks[start], [], [], False
            if kinds[start] == 0:
                times.append(part["times"].to_numpy())
                best.append(part["best"].to_numpy(zero_copy_only=False))
                continue
            if not reading:
                times, best, reading = np.concatenate([np.zeros(0, np.int64), *times]), np.concatenate([np.zeros(0, bool), *best]), True
            sums = []
            for slots in part["slots"].to_pylist():
                number, n = unpacked(slots)
                sums.append((int(n[best[number]].sum()), int((n * times[number]).sum())))
            columns = [part[c] for c in ("doc_id", *_COUNTS, "groups")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([s[k] for s in sums], pa.int64()) for k in (0, 1))], names=["doc_id", *_COUNTS, "groups", "n_best", "count_sum"])


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment(read_table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
