"""Fill-in-the-middle transformation with the `tokenizers` library's Split pre-tokenizer (operator 11).

Split, with its regular expression's matches isolated, cuts a text into units and
gives their offsets in code points; nothing is trained. The length of the array
of offsets is n, and its entries at two ranks, drawn from a hash of the id, are
where prefix and middle end. A text is cut by itself, so rows are mapped where
they are read, without a shuffle; a long text goes through the library in chunks
that end where a unit does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import read_table

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are transformed, and of 100 of those so many have the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SEED = 42
#: Code points that the library is given at once, and bytes of output held.
CHUNK, HELD = 1 << 16, 8 << 20
#: A place where a unit must end: between a word and white space.
_BREAK = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")


@lru_cache(maxsize=1)
def splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(UNIT), "isolated")


def unit_ends(text: str, chunk: int = CHUNK) -> np.ndarray:
    """Where each unit of the text ends, in code points."""
    split, found, at = splitter(), [np.zeros(0, np.int64)], 0
    while at < len(text):
        stop = _BREAK.search(text, at + chunk)
        end = stop.end() if stop else len(text)
        found.append(at + np.array([b for _, (_, b) in split.pre_tokenize_str(text[at:end])], np.int64))
        at = end
    return np.concatenate(found)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers of a row; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def transform(doc_id: int | None, text: str, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text; form is plain, psm or spm."""
    ends = unit_ends(text)
    n, (h1, h2, h3, h4) = len(ends), draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output.

    Null text counts as empty, has no units and stays plain; so do texts that hold
    a sentinel. Repeated rows give repeated rows; an id decides alike for all rows
    that have it, and rows without id are decided as one. Other columns are not
    read. An empty table gives an empty one.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append((doc_id, *transform(doc_id, text.as_py() or "", seed, rate, suffix_first)))
                held += len(rows[-1][-1])
                if held > HELD:  # memory stays bounded whatever a batch holds
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text, rebuilt from an output and its form alone.

    A transformed text holds no sentinel, and sentinels have "<" at their start
    alone, so the first of each is the one that was put in.
    """
    opened = F.substr(output, F.lit(1 + len(PREFIX)))

    def parts(sentinel: str) -> list[Column]:
        """What stands before the sentinel, between it and the last one, and after that."""
        before = F.substring_index(opened, sentinel, 1)
        rest = F.substr(opened, F.length(before) + 1 + len(sentinel))
        between = F.substring_index(rest, MIDDLE, 1)
        return [before, between, F.substr(rest, F.length(between) + 1 + len(MIDDLE))]

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"))


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, [('0x' || substr(hex, k * 8 + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM rows),
cut AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
