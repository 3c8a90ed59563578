"""Byte-level BPE: whole texts to token ids and back, with the tiktoken library and a local rank file."""

from __future__ import annotations

import array
import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.llm.staging import unused
from labtide.llm.words import slices

# The characters that \s of the pattern matches, and the pattern's alternatives for runs of them.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_RULE = r"|\s+(?!\S)|\s+"
LONG = 1 << 16
LONG_RUN = 1 << 13

# No match goes on from a character that is no space to one that is, so a text may be cut between them.
BOUNDARY = re.compile(f"[^{SPACES}](?=[{SPACES}])")
RUN = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")


def segments(text: str, long: int = LONG, run: re.Pattern = RUN) -> Iterator[tuple[str, bool]]:
    """A text in parts whose matches are those of the whole, each with whether it is one match by itself.

    Texts of up to ``long`` characters are one part. Longer ones are cut where a space follows another character. Very
    long runs of spaces, on which the library's matcher gives up, are matches of their own: all of a run at the end of
    the text, else all but its last character, which the next match may begin with.
    """
    if len(text) <= long:
        yield text, False
        return
    at = 0
    for found in [*run.finditer(text), None]:
        stop = len(text) if found is None else found.start()
        while stop - at > long:
            edge = BOUNDARY.search(text, at + long - 1, stop)
            if edge is None:
                break
            yield text[at : edge.end()], False
            at = edge.end()
        if stop > at:
            yield text[at:stop], False
        if found is not None:
            at = found.end() if found.end() == len(text) else found.end() - 1
            yield text[stop:at], True


@lru_cache(maxsize=2)
def codec(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once in a Python worker."""
    if not pattern.endswith(SPACE_RULE):
        raise ValueError(f"the pattern must end in {SPACE_RULE}, which tells where texts may be cut")
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def token_ids(text: str, by: tiktoken.Encoding) -> array.array:
    """All ids of a text, as unsigned 32-bit numbers."""
    ids = array.array("I")
    for part, single in segments(text):
        ids.extend(by._encode_single_piece(part.encode()) if single else by.encode_ordinary(part))
    return ids


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document: its whole text's ids as little-endian unsigned 32-bit numbers.

    ``ranks`` is a file every executor can open. Special tokens are ordinary text. A null or empty text has no ids. Rows
    with the same or a null doc_id are documents of their own; other columns are left out. Memory follows the longest
    text: batches are worked through in slices of some megabytes.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(ranks, pattern)
        for part in parts:
            for some in slices(part):
                ids = [token_ids(text.as_py() or "", by) for text in some.column(1)]
                counts = pa.array([len(i) for i in ids], pa.int64())
                data = pa.array([np.array(i, dtype="<u4").tobytes() for i in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), counts, data], names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id bigint, n_tokens bigint, ids binary")


def decoded(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``rows`` with ``data``, the bytes that their column ``ids`` stands for; null ids give null.

    Bytes are joined as they are: ids that end within a character give the bytes of that part of it. A column of that name
    that is there already stays, and the new one has underscores added.
    """
    name = unused("data", rows.columns)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = codec(ranks, pattern)
        for part in parts:
            held = part.column(part.schema.get_field_index("ids"))
            data = [None if v is None else by.decode_bytes(np.frombuffer(v, dtype="<u4").tolist()) for v in held.to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=[*part.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(batches, f"{kinds}, {name} binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes they decode to, for every document."""
    rows = decoded(encoded(docs, ranks, pattern), ranks, pattern)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )
