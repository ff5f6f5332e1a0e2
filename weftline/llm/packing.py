"""Packing by power-of-two decomposition (operator 2).

A document's ids are cut into whole sequences of 2048 and then by the binary
digits of what is left, largest first. Every piece is a sequence of its own, so
no sequence crosses documents and none is padded; equal lengths form a bucket.
Deciding needs no other document, so rows are mapped where they are read, without
a shuffle.

Ids are those of the `tokenizers` file. The same vocabulary in `tiktoken` gives
equal ids at a quarter of the time; texts that hold the file's special token, which
only the first reads as such, or a run of white space too long for the second, go
through `tokenizers` itself.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from weftline.llm import textkit
from weftline.llm.common import read_table

LONGEST = 2048
#: The id that ends a document, and the special token of the vocabulary.
END, SPECIAL = 1, "<|endoftext|>"


@lru_cache(maxsize=2)
def encoder(json_path: str | None = None, ranks_path: str | None = None):
    """text -> list of ids; paths default to the public 50k byte-level vocabulary."""
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path or public.path("byte_bpe_50k.json"))
    with open(ranks_path or public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL in text or textkit.has_long_run(text):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Whole sequences first, then the binary digits of the rest, largest first; they add up to n."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, longest: int = LONGEST, with_ids: bool = True, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece of each row of `docs` (columns doc_id, text).

    Null text counts as empty and gives the single id 1. Repeated rows are packed
    each on its own. sequence_id is unique; it numbers pieces within a partition
    of the input. bucket is the power of two; ids are the piece's ids.
    `longest` is a power of two.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("bucket", pa.int32())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, nth = encoder(json_path, ranks_path), 0
        first = TaskContext.get().partitionId() << 36
        for batch in batches:
            cols: dict[str, list] = {k: [] for k, _ in fields}
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                start = 0
                for n in piece_lengths(len(ids), longest):
                    piece = ids[start : start + n]
                    row = (doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), first + nth, 0, n.bit_length() - 1)
                    for (k, _), v in zip(fields, row):
                        cols[k].append(v)
                    if with_ids:
                        cols["ids"].append(piece.astype(np.int32))
                    start, nth = start + n, nth + 1
                held += len(ids)
                if held > 1 << 21:  # memory stays bounded whatever a batch holds
                    yield pa.RecordBatch.from_pydict(cols, schema)
                    cols, held = {k: [] for k, _ in fields}, 0
            yield pa.RecordBatch.from_pydict(cols, schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), with_ids=False)
