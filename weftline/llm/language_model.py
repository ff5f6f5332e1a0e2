"""Language-model scoring by context-tree weighting over bytes (operator 9).

A text is its lower-cased words joined by single spaces and ended by a line feed.
Each byte is eight binary decisions; the context of a decision is the decisions
made of its byte and the bytes before it, up to DEPTH. Every node of the context
tree has a Krichevsky-Trofimov estimate; a node's probability is half its own
estimate and half the product of its children's, which mixes all depths. The tree
is learned from counts of (DEPTH + 1)-byte strings of all training documents,
gathered once; strings that only held-out texts have come along with count 0, so
that scoring is a lookup. -log2 of the probability by byte is the code length.

The table of strings grows with the corpus and is never gathered in one place. The
tree is cut into a layer of two context bytes at the bottom and layers of one above
it: a task folds whole subtrees, of the strings that share DEPTH - 2 context bytes or
of 255 * 256 nodes at most, into one row per decision and context of the layer above, and the same layers are gone down again with what the nodes above say.
Only the top, 255 * 256 nodes, is worked out on the driver. Texts are dealt into
blocks of about BLOCK_BYTES; a block asks for each of its distinct strings and words
once, the answers come by a join, and the block is scored with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import textkit
from weftline.llm.common import id_bucket, materialize, read_table, release, releasing

DEPTH = 5
#: Bytes of text that are scored together, and strings or nodes of the tree that a task takes at once (whole subtrees).
BLOCK_BYTES, CHUNK = 16 << 20, 1 << 16
#: Partitions for each block: among as many partitions as there are blocks, a hash deals several blocks to one task.
SPREAD = 4
#: Bytes of text that numpy takes at once.
PIECE = 1 << 19
#: Distinct items that a task holds before it hands them on.
HELD = 2_000_000
END = 0x0A


def held_out(doc_id: str = "doc_id"):
    return id_bucket(10, doc_id) == 0


def stream(block: textkit.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where texts begin in them, word hashes, their texts) of a block in normal form."""
    data = textkit.lower(block.data)
    starts, ends, rows = textkit.words(data, block.offsets)
    hashes = textkit.span_hashes(data, starts, ends)
    empty = np.setdiff1d(np.arange(block.n), rows)
    s, lengths, r = np.concatenate((starts, np.zeros(len(empty), np.int64))), np.concatenate((ends - starts, np.zeros(len(empty), np.int64))), np.concatenate((rows, empty))
    if len(empty):
        order = np.argsort(r, kind="stable")
        s, lengths, r = s[order], lengths[order], r[order]
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.zeros(at[-1], np.uint8)
    source = np.repeat(s - at[:-1], lengths + 1) + np.arange(at[-1])
    if len(data):
        out[:] = data[np.minimum(source, len(data) - 1)]
    last = np.ones(len(r), bool)
    last[:-1] = r[1:] != r[:-1]
    out[at[1:] - 1] = np.where(last, END, 0x20)
    first = np.ones(len(r), bool)
    first[1:] = r[1:] != r[:-1]
    return out, at[:-1][first], hashes, rows


def string_codes(data: np.ndarray, begins: np.ndarray, depth: int) -> np.ndarray:
    """For each byte: itself and the `depth` bytes before it in its text, nearest first, as one number; line feeds stand before a text."""
    code = data.astype(np.uint64)
    finish = np.concatenate((begins[1:], [len(data)]))
    for d in range(1, depth + 1):
        before = np.full(len(data), END, np.uint8)
        before[d:] = data[:-d]
        outside = (begins[:, None] + np.arange(d)).ravel()
        before[outside[outside < np.repeat(finish, d)]] = END
        code = code << np.uint64(8) | before
    return code


class Counter:
    """Counts of 64-bit items in sorted arrays."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, items: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.parts.append(totals(items, weights))
        self.size += len(self.parts[-1][0])
        if self.size > HELD and len(self.parts) > 1:
            self.merge()

    def merge(self) -> None:
        if self.parts:
            self.parts = [totals(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))]
            self.size = len(self.parts[0][0])


def totals(items: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        items = np.sort(items)
    else:
        order = np.argsort(items, kind="stable")
        items, weights = items[order], weights[order]
    new = np.flatnonzero(np.concatenate(([True], items[1:] != items[:-1]))) if len(items) else np.zeros(0, np.int64)
    if not len(items):
        return items, np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(items))) if weights is None else np.add.reduceat(weights, new)
    return items[new], counts


def gather(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, item, n): words (kind 0) of training texts and strings (kind 1) of all texts, n in training texts; kind 2 has the bytes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {(kind, w): Counter() for kind in (0, 1) for w in (0, 1)}

        def out():
            for (kind, w), counter in found.items():
                counter.merge()
                for items, counts in counter.parts:
                    for at in range(0, len(items), 1 << 18):
                        part = items[at : at + (1 << 18)]
                        yield pa.RecordBatch.from_pydict({"kind": np.full(len(part), kind, np.int32), "item": part.view(np.int64), "n": counts[at : at + (1 << 18)].astype(np.int64) * w})
                counter.parts, counter.size = [], 0

        size = 0
        for batch in batches:
            train = ~batch.column(1).to_numpy(zero_copy_only=False)
            for block in textkit.blocks(batch.column(0), PIECE):
                data, begins, hashes, rows = stream(block)
                own = train[block.first : block.first + block.n]
                found[0, 1].add(hashes[own[rows]])
                codes = string_codes(data, begins, depth)
                size += len(data)
                mine = np.repeat(own, np.diff(np.append(begins, len(data))))
                found[1, 1].add(codes[mine])
                found[1, 0].add(codes[~mine])
                if sum(c.size for c in found.values()) > 3 * HELD:
                    yield from out()
        yield from out()
        yield pa.RecordBatch.from_pydict({"kind": np.full(1, 2, np.int32), "item": np.zeros(1, np.int64), "n": np.full(1, size, np.int64)})

    counted = docs.select("text", held_out().alias("held")).mapInArrow(releasing(run), "kind int, item long, n long")
    return materialize(counted.groupBy("kind", "item").agg(F.sum("n").alias("n")), "strings")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, brought back by the recurrence."""
    product = x.copy()
    for k in range(1, 8):
        product = product * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


def kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def leaves(codes: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The deepest nodes of eight decisions of each string: (keys, zeros, ones, each string's nodes, its bits)."""
    byte, context = codes >> np.uint64(8 * depth), codes & np.uint64((1 << 8 * depth) - 1)
    keys = np.concatenate([(np.uint64(1 << i) | byte >> np.uint64(8 - i)) << np.uint64(8 * depth) | context for i in range(8)])
    ones = np.concatenate([(byte >> np.uint64(7 - i) & np.uint64(1)).astype(bool) for i in range(8)])
    order = np.argsort(keys)
    key = keys[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    at = np.flatnonzero(new)
    leaf = np.empty(len(keys), np.int64)
    leaf[order] = np.cumsum(new) - 1
    n = np.tile(counts.astype(float), 8)
    b = np.add.reduceat(np.where(ones, n, 0)[order], at)
    a = np.add.reduceat(np.where(ones, 0, n)[order], at)
    return key[at], a, b, leaf.reshape(8, -1), ones.reshape(8, -1)


def climb(key: np.ndarray, a: np.ndarray, b: np.ndarray, weighted: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Levels]:
    """Nodes, sorted by key, so many levels up, and by level (parents, weight of stopping there, chance of a one there)."""
    out = []
    for _ in range(levels):
        key = key >> np.uint64(8)
        new = np.concatenate(([True], key[1:] != key[:-1]))
        at = np.flatnonzero(new)
        a, b, below, key = np.add.reduceat(a, at), np.add.reduceat(b, at), np.add.reduceat(weighted, at), key[at]
        own = kt(a, b)
        weighted = np.logaddexp(own, below) - np.log(2)
        out.append((np.cumsum(new) - 1, np.exp(own - np.log(2) - weighted), (b + 0.5) / (a + b + 1)))
    return key, a, b, weighted, out


def mix(levels: Levels, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(top node, A, B) of each node: the chance at the top is A, with the node's own `chance` in it, and what is added to that comes in B times."""
    up, share = np.arange(len(chance)), np.ones(len(chance))
    for parent, stay, p in levels:
        up = parent[up]
        chance = stay[up] * p[up] + (1 - stay[up]) * chance
        share = (1 - stay[up]) * share
    return up, chance, share


def strings_log10(codes: np.ndarray, counts: np.ndarray, depth: int, levels: int, above=None) -> np.ndarray:
    """log10 of the probability of each string's last byte after the others. `above` gives (A, B) of the nodes so many levels up; at the root it is not needed."""
    keys, a, b, leaf, ones = leaves(codes, counts, depth)
    top, *_, way = climb(keys, a, b, kt(a, b), levels)
    up, chance, _ = mix(way, (b + 0.5) / (a + b + 1))
    if above:
        add, share = above(top)
        chance = add[up] + share[up] * chance
    return np.log10(np.where(ones, chance[leaf], 1 - chance[leaf])).sum(0)


def tree_log10(codes: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
    """The whole tree in one place."""
    return strings_log10(codes, counts, depth, depth)


def distinct_of(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct items. np.unique hashes integers since numpy 2.3, which takes ten times as long as sorting them."""
    return totals(np.concatenate(lists))[0] if lists else np.zeros(0, np.uint64)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about CHUNK rows of batches sorted by `part`; no part is split."""
    held, size, enough = [], 0, CHUNK
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= enough:
            table = pa.Table.from_batches(held)
            part = table["part"].to_numpy()
            last = int(np.searchsorted(part, part[-1]))
            if last:
                yield table.slice(0, last)
            held, size = table.slice(last).to_batches(), table.num_rows - last
            enough = max(CHUNK, 2 * size)
    if size:
        yield pa.Table.from_batches(held)


NODE = "key long, a double, b double, w double"


def _layer(rows: DataFrame, level: int, to: int, deepest: bool, tasks: int, above: DataFrame | None = None) -> DataFrame:
    """Nodes (or strings) of `level` folded to nodes of level `to`; or, given (A, B) of those, (A, B) of nodes or (item, value) of strings."""

    def part(at: int):
        return F.shiftright(F.col("key").bitwiseAND(F.lit((1 << 8 * at) - 1)), 8 * (at - to)).alias("part")

    def columns(table: pa.Table, kind: int) -> list[np.ndarray]:
        own = table.filter(pa.compute.equal(table["kind"], kind))
        order = np.argsort(own["key"].to_numpy())
        return [own["key"].to_numpy()[order].view(np.uint64), *(own[c].to_numpy()[order] for c in "abw")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key, a, b, w = columns(table, 0)
            if deepest:
                key, a, b, *_ = leaves(key, a, level)
                w = kt(a, b)
            key, a, b, w, _ = climb(key, a, b, w, level - to)
            yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "a": a, "b": b, "w": w})

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key, a, b, w = columns(table, 0)
            known, add, share, _ = columns(table, 1)

            def answer(keys, known=known, add=add, share=share):
                at = np.searchsorted(known, keys)
                return add[at], share[at]

            if deepest:
                yield pa.RecordBatch.from_pydict({"item": key.view(np.int64), "value": strings_log10(key, a, level, level - to, answer)})
            else:
                top, *_, way = climb(key, a, b, w, level - to)
                up, chance, part_of = mix(way, np.zeros(len(key)))
                add, share = answer(top)
                yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "a": add[up] + share[up] * chance, "b": share[up] * part_of, "w": np.zeros(len(key))})

    given = rows.select(F.lit(0).alias("kind"), "key", "a", "b", "w", part(level))
    if above is not None:
        given = given.union(above.select(F.lit(1), "key", "a", "b", F.lit(0.0), part(to)))
    dealt = given.repartition(tasks, "part").sortWithinPartitions("part")
    if above is None:
        return dealt.mapInArrow(releasing(fold), NODE)
    return dealt.mapInArrow(releasing(unfold), "item long, value double" if deepest else NODE)


def tree(strings: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(item, value) of strings (item, n): tree_log10 by layers."""
    spark = strings.sparkSession
    tasks = 1 + strings.count() // (4 * CHUNK)
    rows, level, layers = strings.select(F.col("item").alias("key"), F.col("n").cast("double").alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("w")), depth, []
    while not layers or level > 1:
        to = level - 2 if level == depth > 2 else max(level - 1, 1)
        layers.append((rows, level, to, level == depth, tasks))
        rows, level = materialize(_layer(*layers[-1]), "nodes"), to
    top = rows.toArrow()  # 255 decisions after 256 bytes at most
    order = np.argsort(top["key"].to_numpy())
    key, a, b, w = (top[c].to_numpy()[order] for c in ("key", "a", "b", "w"))
    if len(key):
        *_, way = climb(key.view(np.uint64), a, b, w, 1)
        _, a, b = mix(way, np.zeros(len(key)))
    above = spark.createDataFrame(pa.table({"key": key, "a": a, "b": b, "w": np.zeros(len(key))}), NODE)
    for layer in reversed(layers):
        above = _layer(*layer, above)
    return above


def lookup(keys: np.ndarray, values: np.ndarray, items: np.ndarray, missing: float) -> np.ndarray:
    """values of items in sorted keys."""
    if not len(keys):
        return np.full(len(items), missing)
    at = np.minimum(np.searchsorted(keys, items), len(keys) - 1)
    return np.where(keys[at] == items, values[at], missing)


class Table:
    """values by distinct 64-bit keys: one slot by a multiplicative hash, the last of its keys there, and a sorted array of the others.

    One to two slots a key: more would leave fewer keys to the sorted array, but a worker's memory is mostly this.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float):
        self.shift = np.uint64(64 - max(4, len(keys).bit_length()))
        self.missing = missing
        slots = 1 << int(np.uint64(64) - self.shift)
        self.keys, self.values = np.zeros(slots, np.uint64), np.full(slots, missing, float)
        # A slot that no key has must not look like one of key 0, whose slot is 0.
        self.keys[0] = 1
        at = self.slot(keys)
        self.keys[at], self.values[at] = keys, values
        lost = np.flatnonzero(self.keys[at] != keys)
        lost = lost[np.argsort(keys[lost])]
        self.lost, self.lost_values = keys[lost], values[lost]

    def slot(self, items: np.ndarray) -> np.ndarray:
        return items * np.uint64(0x9E3779B97F4A7C15) >> self.shift

    def get(self, items: np.ndarray) -> np.ndarray:
        at = self.slot(items)
        out = self.values[at]
        missed = np.flatnonzero(self.keys[at] != items)
        out[missed] = lookup(self.lost, self.lost_values, items[missed], self.missing)
        return out


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Null text is empty: its one token is the end. A null doc_id counts as empty text
    for the split. Repeated rows are scored each, in one block. Without training
    documents N and V are 0 and every count is 0. No documents give no rows. Other
    columns are not read.
    """
    table = gather(docs, depth)
    train_docs = docs.where(~held_out()).count()
    words = table.where("kind = 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_blocks = 1 + int(table.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // block_bytes
    total, distinct = int(total) + train_docs, distinct + (train_docs > 0)
    smooth = 0.1 * (distinct + 1)
    log_p = lambda c: np.log10((c + 0.1) / (total + smooth))
    values = tree(table.where("kind = 1"), depth).select(F.lit(1).alias("kind"), "item", "value")
    values = values.union(words.select("kind", "item", F.col("n").cast("double")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct items by block; those of a very long text come in more than one list, which is harmless."""
        now, found = -1, ([], [])

        def out():
            for kind, lists in enumerate(found):
                items = distinct_of(lists)
                for at in range(0, len(items), 1 << 18):
                    part = items[at : at + (1 << 18)]
                    yield pa.RecordBatch.from_pydict({"block": np.full(len(part), now, np.int64), "kind": np.full(len(part), kind, np.int32), "item": part.view(np.int64)})
                lists.clear()

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1), batch.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                if blocks[x] != now:
                    yield from out()
                    now = int(blocks[x])
                for block in textkit.blocks(batch.column(3).slice(x, y - x), PIECE):
                    data, begins, hashes, _ = stream(block)
                    found[0].append(distinct_of([hashes]))
                    found[1].append(distinct_of([string_codes(data, begins, depth)]))
                    for lists in found:
                        if sum(map(len, lists)) > HELD:
                            lists[:] = [distinct_of(lists)]
                    if sum(len(lists[0]) for lists in found) > HELD:
                        yield from out()
        yield from out()

    def answer(texts: pa.Table, known: pa.Table) -> pa.Table:
        kinds, items, values = known["kind"].to_numpy(), known["item"].to_numpy().view(np.uint64), known["value"].to_numpy()
        # A word that no training text has counts 0; a string of the block that nobody asked for is a fault.
        tables = [Table(items[kinds == kind], values[kinds == kind], missing) for kind, missing in ((0, 0.0), (1, np.nan))]
        del known, kinds, items, values
        out = []
        for batch in texts.to_batches():
            for block in textkit.blocks(batch.column("text"), PIECE):
                data, begins, hashes, rows = stream(block)
                logs = tables[1].get(string_codes(data, begins, depth))
                if np.isnan(logs).any():
                    raise RuntimeError("a block holds a string that was not asked for: the table was read anew with other rows")
                c = tables[0].get(hashes)
                own = batch.slice(block.first, block.n)
                out.append(
                    pa.table(
                        {
                            "doc_id": own.column("doc_id"),
                            "held_out": own.column("held_out"),
                            "n_tokens": np.bincount(rows, minlength=block.n) + 1,
                            "n_known": np.bincount(rows, c > 0, block.n).astype(np.int64) + (train_docs > 0),
                            "base_score": np.bincount(rows, log_p(c), block.n) + log_p(train_docs),
                            "score": np.add.reduceat(logs, begins),
                            "n_bytes": np.diff(np.append(begins, len(data))),
                        }
                    )
                )
        del tables
        release()
        return pa.concat_tables(out) if out else pa.table({f.name: pa.array([], f.type) for f in arrow})

    arrow = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])
    # Dealt by the row itself, so it is the same block each time the table is read, in whatever order.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block")
    given = docs.select(block, F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").repartition(SPREAD * n_blocks, "block")
    asked = given.sortWithinPartitions("block").mapInArrow(releasing(ask), "block long, kind int, item long")
    known = asked.join(values, ["kind", "item"]).select("block", "kind", "item", "value")
    scored = given.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(answer, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    bits = -F.col("score") / np.log10(2) / F.col("n_bytes")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
