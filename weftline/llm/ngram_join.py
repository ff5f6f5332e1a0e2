"""N-gram Jaccard join over a count-vector R-tree (operator 3).

A document is its set of distinct 5-word shingles, as 64-bit hashes. Equal sets
are one node, numbered by the first half of its digest, so rows that share an id
but not a text stay apart. Two sets link when 100 * |both| >= 80 * |either|; then at least 4/5
of each is shared, so under any one order of shingles the first n - ceil(4n/5) + 1
of both have one in common: that shingle is where they meet. The order puts
shingles that are frequent in some part of the corpus last, so meeting places
stay small; any order gives the same links.

Each set is first verified against one pivot, the smallest node of the place
where it meets others most often: a pair a set, however large its group. Places
whose sets are then all of one component hold nothing more to find. At every
other place the sets' count vectors (shingles by hash group) are points of an
R-tree: the summed minima of two vectors, or of a vector and a box's upper
corner, bound the overlap. Each set is verified against the nearest of another
component there, and at the places that are still mixed all pairs of different
components that survive the bound are verified on their shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import textkit
from weftline.llm.common import discard, join_to_classes, materialize, read_table, release, smallest_broadcast, whole_row
from weftline.llm.components import connected_components

WIDTH = 5
#: 100 * |both| >= SHARE * |either|
SHARE = 80
#: Hash groups of a count vector, one byte each: the tree uses GROUPS; a set keeps two or more for each shingle up to
#: FINE groups, beyond that so many that a group has about PER_GROUP shingles.
GROUPS, FINE, PER_GROUP = 64, 512, 4
#: Shingles met this often within one block of texts are counted over the corpus; at most MOST_COMMON are put last.
OFTEN, MOST_COMMON = 4, 1_000_000
#: Points that one task joins with as many others, and their shingles (a count vector has no more bytes than about four
#: times these), leaf size and fan-out of the tree.
TILE, TILE_BYTES, LEAF, FAN = 2048, 8 << 20, 32, 16
BROADCAST_NODES = 1_000_000
#: Partners of one set that a task verifies.
HUB_ROWS = 2048
#: Bits of the map of keys that several sets hold: MAP_SPARE for each key of a set, MAP_BITS at most; where it fills up, more keys are shuffled.
MAP_SPARE, MAP_BITS = 8, 1 << 27


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent shingles, sorted; MOST_COMMON at most, since counts above total / MOST_COMMON can't be more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(0)):
                data = textkit.lower(block.data)
                starts, ends, rows = textkit.words(data, block.offsets)
                hashes = textkit.span_hashes(data, starts, ends)
                u, n = np.unique(_rolled(hashes, rows), return_counts=True)
                u, n = u[n >= OFTEN], n[n >= OFTEN]
                yield pa.RecordBatch.from_pydict({"key": u.view(np.int64), "n": n.astype(np.int64)})

    counted = materialize(docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "common")
    least = max(2 * OFTEN, (counted.agg(F.sum("n")).first()[0] or 0) // MOST_COMMON + 1)
    found = counted.where(F.col("n") >= least).select("key").toArrow()["key"].to_numpy()
    return np.sort(found.view(np.uint64))


def _rolled(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    if len(hashes) < WIDTH:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - WIDTH + 1, np.uint64)
    for j in range(WIDTH):
        out = out * np.uint64(textkit._P) + hashes[j : len(hashes) - WIDTH + 1 + j]
    return textkit.finish(out)[rows[: len(out)] == rows[WIDTH - 1 :]]


def shingle_sets(block: textkit.Block) -> list[np.ndarray]:
    data = textkit.lower(block.data)
    starts, ends, rows = textkit.words(data, block.offsets)
    return textkit.shingles(textkit.span_hashes(data, starts, ends), rows, block.n, WIDTH)


def digest(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set of hashes."""
    place = np.arange(1, len(x) + 1, dtype=np.uint64)
    mixed = textkit.finish(x ^ textkit.finish(place))
    return int(mixed.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed * np.uint64(0xD1342543DE82EF95)).view(np.int64))


def prefix(x: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of a sorted set at which it meets others, in the order rare before common, then by hash."""
    n = len(x)
    take = n - -(-SHARE * n // 100) + 1
    if len(common):
        often = common[np.minimum(np.searchsorted(common, x), len(common) - 1)] == x
        x = np.concatenate((x[~often], x[often]))
    return x[:take]


def count_vector(x: np.ndarray) -> np.ndarray:
    """Shingles by hash group, a power of two of groups; no count passes a byte, so vectors stay exact bounds."""
    groups = max(GROUPS, 1 << max(min(2 * len(x), FINE - 1), len(x) // PER_GROUP).bit_length())
    while True:
        counts = np.bincount((x & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        groups *= 2


def fold(vec: np.ndarray, groups: int) -> np.ndarray:
    """The vector, or each row of a matrix, with fewer groups, both powers of two."""
    return vec.reshape(*vec.shape[:-1], -1, groups).sum(-2, dtype=np.int64)


def may_link(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the summed minima of count vectors, at the finest resolution that both have, leave a link possible; y may be a matrix."""
    groups = min(x.shape[-1], y.shape[-1])
    x, y = fold(x, groups), fold(y, groups)
    return (100 + SHARE) * np.minimum(x, y).sum(-1) >= SHARE * (x.sum() + y.sum(-1))


def profiles(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(doc_id, h, n, d1, d2, keys, vec) of each row: hash of the text, set size, digest, meeting places, count vector."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(1)):
                sets = shingle_sets(block)
                d = [digest(x) for x in sets]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(block.first, block.n), "h": batch.column(2).slice(block.first, block.n), "n": np.array([len(x) for x in sets], np.int64), "d1": [a for a, _ in d], "d2": [b for _, b in d], "keys": pa.array([prefix(x, shared.value).view(np.int64) if len(x) else np.zeros(0, np.int64) for x in sets], pa.list_(pa.int64())), "vec": [count_vector(x).tobytes() for x in sets]})

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h")).mapInArrow(run, "doc_id long, h long, n long, d1 long, d2 long, keys array<long>, vec binary")


def shared_keys_map(rows: DataFrame) -> np.ndarray:
    """A bitmap with the bits of all keys that two different sets hold; it may hold others, but misses none. Its size goes with the table's, as driver and executors hold it."""
    keys = rows.agg(F.sum(F.floor(F.col("n") / WIDTH) + 1)).first()[0] or 0  # of n shingles a fifth and one are keys, at most
    n_bits = min(MAP_BITS, max(1 << 16, 1 << (MAP_SPARE * keys).bit_length()))
    held = rows.select("d1", F.explode("keys").alias("key")).groupBy("key").agg(F.min("d1").alias("low"), F.max("d1").alias("high"))
    bit = F.pmod(F.col("key"), F.lit(n_bits))
    marked = held.where("low < high").select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at"))
    out = np.zeros(n_bits // 8 + 4096, np.uint8)
    for r in marked.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toLocalIterator():
        # bucket k holds the numbers from (k - 1) * 32768 + 1 on, and bucket 0 the number 0
        part = np.frombuffer(r["bits"], np.uint8)
        out[(r["bucket"] - 1) * 4096 + 4096 : (r["bucket"] - 1) * 4096 + 4096 + len(part)] = part
    return out


def meetings(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """(key, d1, d2, doc_id, n): the sets at each key of the bitmap; doc_id is the smallest id with the set."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    n_bits = (len(bits) - 4096) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            keys = lists.flatten().to_numpy()
            number = np.mod(keys, n_bits)
            number = np.where(number == 0, 0, number - 1 + 32768)
            hit = (shared.value[number >> 3] >> (number & 7).astype(np.uint8) & 1).astype(bool)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[hit]
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), *(batch.column(c).take(pa.array(row)) for c in (2, 3, 0, 1))], names=["key", "d1", "d2", "doc_id", "n"])

    found = rows.where("doc_id IS NOT NULL").select("doc_id", "n", "d1", "d2", "keys").mapInArrow(run, "key long, d1 long, d2 long, doc_id long, n long")
    return found.groupBy("key", "d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))


class CountTree:
    """An R-tree over count vectors that keeps the upper corner of each box, bulk-loaded by size and then by first groups."""

    def __init__(self, points: np.ndarray):
        self.order = np.lexsort((points[:, 0], points.sum(1)))
        self.points = points[self.order]
        level = self.points
        self.corners: list[np.ndarray] = []  # from the leaves' boxes up
        step = LEAF
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), step), axis=0)
            self.corners.append(level)
            step = FAN
        self.sizes = self.points.sum(1)

    def reaching(self, query: np.ndarray) -> np.ndarray:
        """Indexes (as given) of the points whose overlap with the query may reach the share."""
        size = query.sum()
        # |both| >= SHARE / (100 + SHARE) * (|x| + |y|), and |y| >= SHARE / 100 * |x| for a linked y
        least = SHARE / 100 * size - 1e-9
        alive = np.zeros(1, np.int64) if self.corners else np.zeros(0, np.int64)
        for depth in range(len(self.corners) - 1, -1, -1):
            if depth < len(self.corners) - 1:
                alive = (alive[:, None] * FAN + np.arange(FAN)).ravel()
                alive = alive[alive < len(self.corners[depth])]
            alive = alive[np.minimum(self.corners[depth][alive], query).sum(1) >= least]
        at = (alive[:, None] * LEAF + np.arange(LEAF)).ravel() if self.corners else np.arange(len(self.points))
        at = at[at < len(self.points)]
        both = np.minimum(self.points[at], query).sum(1)
        return self.order[at[(100 + SHARE) * both >= SHARE * (self.sizes[at] + size)]]


def _joined_places(nearest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows (key, i, j, side, node, label, vec), sorted by place, the candidate pairs of different labels at each; with `nearest` one a node."""

    def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        side, node, label = (t[c].to_numpy() for c in ("side", "node", "label"))
        full = [np.frombuffer(v, np.uint8) for v in t["vec"].to_pylist()]
        width = np.array([len(v) for v in full])
        at, stacked = np.zeros(len(full), np.int64), {}
        for w in np.unique(width).tolist():
            mine = np.flatnonzero(width == w)
            at[mine], stacked[w] = np.arange(len(mine)), np.stack([full[k] for k in mine])
        points = np.array([fold(v, GROUPS) for v in full])
        right = np.flatnonzero(side != 0)
        left = np.flatnonzero(side != 1)
        if not len(right) or not len(left):
            return
        tree = CountTree(points[right])
        for q in left:
            hit = right[tree.reaching(points[q])]
            hit = hit[label[hit] != label[q]]
            if side[q] == 2:
                hit = hit[node[hit] > node[q]]
            if len(hit):
                parts = [hit[width[hit] == w] for w in np.unique(width[hit])]
                hit = np.concatenate([p[may_link(full[q], stacked[width[p[0]]][at[p]])] for p in parts])
            if nearest and len(hit):
                hit = hit[[np.minimum(points[hit], points[q]).sum(1).argmax()]]
            if len(hit):
                yield pa.RecordBatch.from_pydict({"a": np.minimum(node[hit], node[q]), "b": np.maximum(node[hit], node[q])})

    return by_place(out)


def by_place(out: Callable[[list[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`out` of the rows of each place; the first three columns name it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and place != tuple(keys[a]):
                    yield from out(held)
                    held = []
                place = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from out(held)

    return run


def bounded(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Of (a, b) the pairs whose summed coordinate minima leave a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v, np.uint8) for v in batch.column(c).to_pylist()] for c in (2, 3))
            keep = [bool(may_link(a, b)) for a, b in zip(x, y)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(vectors.select(F.col("node").alias("a"), F.col("vec").alias("x")), "a").join(vectors.select(F.col("node").alias("b"), F.col("vec").alias("y")), "b")
    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """Of (a, b) the pairs that link, by the sets of their nodes (node, doc_id, d2).

    b's set is sent to a's, once a pair. A task holds a's alone and reads the others
    one by one; a's set goes to as many tasks as HUB_ROWS partners each call for.
    """
    hubs = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners")).withColumn("shares", F.ceil(F.col("partners") / HUB_ROWS))
    ends = join_to_classes(pairs, hubs, ["a"], "partners", pairs.count())
    ends = ends.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"))
    ends = ends.union(hubs.select("a", "a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1))))
    wanted = materialize(ends.join(nodes, "node"), f"{label}-nodes")
    sets = _sets_of(docs, smallest_broadcast(wanted, wanted.count(), BROADCAST_NODES))
    # Not kept as a table: sets are as large as texts, and are read once.
    met = sets.repartition("hub", "share").sortWithinPartitions("hub", "share", F.col("node") != F.col("hub"))
    links = materialize(met.select("hub", "node", "shingles").mapInArrow(_linked, "a long, b long").distinct(), label)
    discard(wanted)
    return links


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that link of rows (hub, node, shingles), where a hub's own set comes before the others."""
    own, x = None, np.zeros(0, np.int64)
    for batch in batches:
        kept = []
        hubs, nodes, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        for k, (hub, node) in enumerate(zip(hubs, nodes)):
            y = values[offsets[k] : offsets[k + 1]]
            if node == hub:
                own, x = hub, y.copy()
                continue
            if own != hub:
                raise RuntimeError(f"the set of node {hub} is missing")
            both = len(np.intersect1d(x, y, assume_unique=True))
            if (100 + SHARE) * both >= SHARE * (len(x) + len(y)):
                kept.append((hub, node))
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in kept], pa.int64()), "b": pa.array([b for _, b in kept], pa.int64())})


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    Null texts and texts without words have no shingles and link with nothing,
    not even with each other; fewer than five words are one shingle. A row
    without id takes the component of its text's other copies. Other columns
    are not read.
    """
    return _similar_rows(docs).drop("h")


def _similar_rows(docs: DataFrame) -> DataFrame:
    """The rows of similar_documents with h, the xxhash64 of the text."""
    common = common_shingles(docs)
    rows = materialize(profiles(docs, common), "profiles")
    bits = shared_keys_map(rows)
    meet = materialize(meetings(rows, bits).withColumnRenamed("d1", "node"), "meetings")
    del common, bits
    release()
    places = meet.groupBy("key").agg(F.min(F.struct("doc_id", "node", "n")).alias("first"), F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"))
    places = places.where("size > 1").select("key", F.col("first.node").alias("pivot"), F.col("first.n").alias("pivot_n"), "size", "members")
    # Places with the same members (the shingles of one passage) are one.
    places = materialize(places.groupBy("size", "members", "pivot", "pivot_n").agg(F.min("key").alias("key")), "places")
    met = join_to_classes(meet, places.select("key", "pivot", "pivot_n", "size"), ["key"], "size", meet.count())
    # Places with the same pivot are one from here on; n_shared says at how many of them a node meets it.
    met = met.groupBy("pivot", "node").agg(F.min("doc_id").alias("doc_id"), F.min("d2").alias("d2"), F.max("n").alias("n"), F.max("pivot_n").alias("pivot_n"), F.count(F.lit(1)).alias("n_shared"))
    met = materialize(met, "met")
    discard(meet)
    discard(places)
    nodes = materialize(met.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("d2").alias("d2")), "met-nodes")
    n_nodes = nodes.count()
    few = smallest_broadcast(nodes, n_nodes, BROADCAST_NODES)
    vectors = rows.select("doc_id", F.col("d1").alias("node"), "d2", "vec").join(few, ["doc_id", "node", "d2"]).groupBy("node").agg(F.first("vec").alias("vec"))
    vectors = materialize(vectors, "vectors")
    # Meeting places and count vectors of all rows aren't read again.
    profiled, rows = rows, materialize(rows.select("doc_id", "h", "n", "d1", "d2"), "rows")
    discard(profiled)
    # Every node is tried with one pivot, the one it meets most often: a pair a node, however large its group.
    star = met.where((F.col("node") != F.col("pivot")) & (100 * F.least("n", "pivot_n") >= SHARE * F.greatest("n", "pivot_n")))
    star = star.groupBy("node").agg(F.max_by("pivot", F.struct("n_shared", "pivot")).alias("pivot")).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    tried = materialize(bounded(star, vectors), "stars")
    links = verified(tried, docs, nodes, "star-links")
    parts = connected_components(links)
    # Then with the nearest of another component at each place, and last with all that the bound leaves.
    for nearest in (True, False):
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = _mixed_places(met, labels_of(nodes, parts, n_nodes), vectors, known)
        pairs = rest.mapInArrow(_joined_places(nearest), "a long, b long").distinct()
        fresh = materialize(pairs.join(known, ["a", "b"], "left_anti"), "tree-pairs")
        links = links.union(verified(fresh, docs, nodes, "tree-links"))
        tried = tried.union(fresh)
        parts = connected_components(links)
    discard(vectors)
    # Components are numbered by digests so far; each takes the smallest id of its nodes.
    least = materialize(nodes.join(parts, "node").groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    parts = parts.join(least, "component").select(F.col("node").alias("d1"), "least")
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("copies"))
    ids = classes.join(parts, "d1", "left").select("d1", "d2", "copies", F.coalesce("least", "own").alias("component"))
    ids = materialize(ids, "classes")
    out = join_to_classes(rows.where("n > 0"), ids, ["d1", "d2"], "copies", rows.count()).select("doc_id", "h", "n", "component")
    return out.unionByName(rows.where("n = 0").select("doc_id", "h", "n", F.col("doc_id").alias("component"))).select("doc_id", "h", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _mixed_places(met: DataFrame, labels: DataFrame, vectors: DataFrame, known: DataFrame) -> DataFrame:
    """(key, i, j, side, node, label, vec) of the places that hold nodes of two labels, by pairs of tiles and sorted by place.

    A place of two nodes is left out if its pair is `known`, as it then holds nothing that wasn't verified.
    """
    labelled = materialize(met.select(F.col("pivot").alias("key"), "node", "n").join(labels, "node"), "labelled")
    tiles = F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum(F.least("n", F.lit(TILE_BYTES))) / TILE_BYTES))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), tiles.alias("tiles"), F.count(F.lit(1)).alias("members"), F.min("node").alias("a"), F.max("node").alias("b")).where("low < high")
    mixed = mixed.where("members > 2").unionByName(mixed.where("members = 2").join(known, ["a", "b"], "left_anti"))
    rest = labelled.join(mixed.select("key", "tiles"), "key").join(vectors, "node")
    rest = rest.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    # Every pair of tiles of a place is one task's; side 2 stands on both sides of it.
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    rest = rest.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), side.alias("side"), "node", "label", "vec")
    return rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def labels_of(nodes: DataFrame, parts: DataFrame, n_nodes: int) -> DataFrame:
    """(node, label): each node's component, itself where it has no link."""
    found = nodes.select("node").join(parts, "node", "left")
    return smallest_broadcast(found.select("node", F.coalesce("component", "node").alias("label")), n_nodes, BROADCAST_NODES)


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hub, share, node, shingles) of the wanted (node, hub, share, doc_id, d2); digests tell rows that share an id apart, and a task gives a pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple[int, int, int]] = set()
        for batch in batches:
            for block in textkit.blocks(batch.column(1)):
                own = batch.slice(block.first, block.n)
                out: dict[str, list] = {"hub": [], "share": [], "node": [], "shingles": []}
                for x, (node, hub, share, d2) in zip(shingle_sets(block), zip(*(own.column(c).to_pylist() for c in (0, 2, 3, 4)))):
                    if (hub, share, node) not in given and digest(x) == (node, d2):
                        given.add((hub, share, node))
                        for name, value in zip(out, (hub, share, node, x.view(np.int64))):
                            out[name].append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(out[c], pa.int64()) for c in ("hub", "share", "node")), pa.array(out["shingles"], pa.list_(pa.int64()))], names=list(out))

    rows = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")
    return rows.select("node", "text", "hub", "share", "d2").mapInArrow(run, "hub long, share long, node long, shingles array<long>")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without those linked to a smaller id, directly or by way of others, with all their columns.

    Rows without words or text, and rows without id, stay; so do rows that repeat
    the id and text of one that stays. An empty table stays empty.
    """
    linked = _similar_rows(docs).where("doc_id <> component_id").select("doc_id", "h").distinct()
    rows = docs.select(whole_row(docs), F.xxhash64("text").alias("h"))
    same = (F.col("row.doc_id") == linked["doc_id"]) & (rows["h"] == linked["h"])
    return rows.join(linked, same, "left_anti").select("row.*")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"))
