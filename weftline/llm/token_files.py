"""Token ids as Arrow stream files of fixed-size lists (operator 12).

Rows are dealt by ranges of their id, so a task has a stretch of the corpus in
order; it encodes its texts and writes their ids end to end as two files: `ids`,
Arrow batches of equal numbers of equal-length sequences with their masks, and
`docs`, which says where each document lies. Only a file's last sequence is padded,
and its mask says so. As all batches of a file but the last are of one size, batch
k is found by arithmetic, and a memory map gives it without a copy.

A table of files, written by Spark, names the files that count and their order:
what a lost task has left isn't in it. Where a document starts in the corpus
follows from the ids of the files before its own.
"""

from __future__ import annotations

import gc
import itertools
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import textkit
from weftline.llm.common import read_table, release, shared_dir

#: Ids of a sequence, sequences of a batch, and bytes of text that a file is made for.
LENGTH, ROWS, FILE_BYTES = 2048, 64, 64 << 20
#: The id that ends a document.
END = 1
#: Words that an encoder remembers, beside those of the texts at hand; words asked for at once; bytes of text encoded at once.
REMEMBERED, ASKED, AT_ONCE = 1 << 21, 1 << 11, 1 << 20
STOPS = b".,;:!?"
MANIFEST = "part int, ids string, docs string, length int, n_ids long, n_sequences long, n_docs long"


class WordEncoder:
    """Ids of whole texts by a `tokenizers` file that lower-cases, drops white space and cuts words at stops, as word_bpe_49k does.

    A text's ids are those of its words, one after the other, so the library is asked
    once for each word that isn't remembered, many of them at a time.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers as public
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public.path("word_bpe_49k.json"))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text's words between ASCII white space, as little-endian unsigned integers of `dtype`."""
        gc.disable()  # many small objects come, and none refers to itself
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        words = [t.split() for t in texts]
        flat = list(itertools.chain.from_iterable(words))
        ids = list(map(self.known.get, flat))
        missing = [k for k, x in enumerate(ids) if x is None]
        if missing:
            found = self._learn({flat[k] for k in missing})
            for k in missing:
                ids[k] = found[flat[k]]
        cuts = itertools.accumulate(map(len, words), initial=0)
        return [b"".join(ids[a:b]) for a, b in itertools.pairwise(cuts)]

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """The ids of new words, which are remembered; what was remembered before goes where that would be too many."""
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
        known, asked, made = self.known, set(), []
        for word in new:
            parts = self._cut(word)
            asked.update(p for p in parts if p not in known)
            if parts != (word,):
                made.append((word, parts))
        known.update(self._library(list(asked)))
        for word, parts in made:
            known[word] = known[parts[0]] if len(parts) == 1 else known[parts[0]] + known[parts[1]]
        return known

    def _cut(self, word: bytes) -> tuple[bytes, ...]:
        """A word of ASCII has the ids of its lower case, and a stop after a letter or digit begins a token in any case."""
        if not word.isascii() or b"<|" in word:
            return (word,)
        low = word.lower()
        core = low.rstrip(STOPS)
        return (core, low[len(core) :]) if core != low and core[-1:].isalnum() else (low,)

    def _library(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """The ids of words, joined by spaces; the offset of a token says which word it is of."""
        for k in range(0, len(words), ASKED):
            texts = [w.decode() for w in words[k : k + ASKED]]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            at = np.searchsorted([start for start, _ in found.offsets], starts)
            ids, bounds = np.array(found.ids, self.dtype).tobytes(), (at * self.dtype.itemsize).tolist()
            yield from zip(words[k : k + ASKED], (ids[a:b] for a, b in zip(bounds, bounds[1:])))


@lru_cache(maxsize=1)
def encoder(path: str | None = None) -> WordEncoder:
    return WordEncoder(path)


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Writes ids end to end as sequences; batches are written as they fill up."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype, length: int, rows: int):
        self.schema, self.length, self.rows = sequence_schema(dtype, length), length, rows
        self.dtype, self.held, self.n_held, self.n_ids = dtype, [], 0, 0
        self.out = pa.ipc.new_stream(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        full = self.length * self.rows
        self.n_ids += len(ids)
        while len(ids):
            part = ids[: full - self.n_held]
            self.held.append(part)
            self.n_held, ids = self.n_held + len(part), ids[len(part) :]
            if self.n_held == full:
                self._flush()

    def _flush(self) -> None:
        values = np.concatenate([*self.held, np.zeros(-self.n_held % self.length, self.dtype)])
        mask = np.arange(len(values)) < self.n_held
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (values, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._flush()
        self.out.close()


class SequenceFile:
    """Random access to the sequences of a file. Over a memory map, what it returns points into the map."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        self.schema = pa.ipc.read_schema(source)
        self.first = source.tell()
        head = self._read()
        self.step, self.rows, self.length = source.tell() - self.first, head.num_rows, self.schema.field("ids").type.list_size
        self.last: tuple[int, pa.RecordBatch] = (0, head)

    def _read(self) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def batch(self, k: int) -> pa.RecordBatch:
        if self.last[0] != k:
            self.source.seek(self.first + k * self.step)
            self.last = (k, self._read())
        return self.last[1]

    def sequence(self, i: int) -> tuple[pa.Array, pa.Array]:
        """(ids, mask) of the file's sequence i."""
        k, at = divmod(i, self.rows)
        return tuple(self.batch(k).column(c).slice(at, 1).flatten() for c in (0, 1))

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids start..start+n of the file, as views of one batch each."""
        full = self.rows * self.length
        while n:
            k, at = divmod(start, full)
            part = self.batch(k).column(0).flatten().to_numpy()[at : at + n]
            yield part
            start, n = start + len(part), n - len(part)


def opened(path: str) -> pa.NativeFile:
    """A memory map of a local file; else the file, to be read piece by piece."""
    store, at = fs.FileSystem.from_uri(path)
    return pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END, length: int = LENGTH, rows: int = ROWS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all rows of `docs` (doc_id, text) to `folder`, in ascending order of doc_id; returns the table of files.

    Null text counts as empty and is the single id `end`. Rows that repeat an id
    follow each other, those that also repeat the text are written each; rows
    without id come first. Other columns are not read. An empty table gives no
    file. `path` names the file of the tokenizer; the folder is one that all
    tasks see.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = docs_out = None
        encode, context, n_docs = encoder(path), TaskContext.get(), 0
        last = np.array([end], encode.dtype)
        for batch in batches:
            if out is None:
                store, base = fs.FileSystem.from_uri(folder)
                store.create_dir(base, recursive=True)
                name = f"{context.partitionId():06d}-{context.taskAttemptId()}.arrows"
                sinks = [store.open_output_stream(f"{base}/{kind}-{name}") for kind in ("ids", "docs")]
                out, docs_out = SequenceWriter(sinks[0], encode.dtype, length, rows), pa.ipc.new_stream(sinks[1], DOCS)
            starts, sizes = [], []
            for block in textkit.blocks(batch.column(1), AT_ONCE):
                data, cuts = block.data.tobytes(), block.offsets.tolist()
                for ids in encode.encode([data[a:b] for a, b in zip(cuts, cuts[1:])]):
                    starts.append(out.n_ids)
                    out.add(np.frombuffer(ids, encode.dtype))
                    out.add(last)
                    sizes.append(out.n_ids - starts[-1])
            n_docs += batch.num_rows
            docs_out.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=DOCS))
        if out is not None:
            out.close()
            docs_out.close()
            for sink in sinks:
                sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([context.partitionId()], pa.int32()), "ids": [f"ids-{name}"], "docs": [f"docs-{name}"], "length": pa.array([length], pa.int32()), "n_ids": [out.n_ids], "n_sequences": [-(-out.n_ids // length)], "n_docs": [n_docs]})
        release()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Copies of one row are told apart by where they are read, so no value of the id is more than a task can have.
    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at"))
    dealt = keyed.repartitionByRange(max(1, -(-size // file_bytes)), "doc_id", "h", "at").sortWithinPartitions("doc_id", "h", "at")
    dealt.select("doc_id", "text").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/files")
    return token_files(spark, folder)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder in order, a row each, with the number of ids before theirs in `base`."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return spark.read.schema(MANIFEST).parquet(f"{folder}/files").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document in the files; start counts the ids of all documents before it."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(f"{folder}/{row['ids']}") as ids, opened(f"{folder}/{row['docs']}") as docs:
                    tokens = SequenceFile(ids)
                    for part in pa.ipc.open_stream(docs):
                        cols, held = {name: [] for name, _ in fields}, 0
                        for doc_id, start, n in zip(*(c.to_pylist() for c in part.columns)):
                            crc, own = 0, []
                            for view in tokens.ids(start, n):
                                crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                                own += [view.astype(np.int32)] * with_ids
                            for name, value in zip(cols, (doc_id, row["base"] + start, n, crc, np.concatenate(own) if own else None)):
                                cols[name].append(value)
                            held += n
                            if with_ids and held > 1 << 21:
                                yield pa.RecordBatch.from_pydict(cols, schema)
                                cols, held = {name: [] for name, _ in fields}, 0
                        yield pa.RecordBatch.from_pydict(cols, schema)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    files = token_files(spark, folder)
    return files.repartition(max(1, files.count()), "part").mapInArrow(run, ddl)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(read_table(spark, sf_dir, "documents"), folder)
    return read_documents(spark, folder, with_ids=False)
