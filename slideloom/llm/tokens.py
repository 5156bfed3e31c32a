"""Encoding of texts with a public byte-level tokenizer, and decoding back.

Method: the tokenizers library over Arrow batches; offsets refer to the characters of the
text; decoding reverses the byte table and puts split characters together again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slideloom.session import spread

#: Folder of the public tokenizers' files; a parameter of every function here.
FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k"
#: Characters encoded in one call; longer batches are cut between texts, never within one.
_CALL_CHARS = 2_000_000


@lru_cache(maxsize=4)
def tokenizer(folder: str = FOLDER, name: str = NAME):
    """The tokenizer of a file, once per process; strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(f"{folder}/{name}.json")
    loaded.encode_special_tokens = True
    return loaded


def _calls(texts: list[str | None]) -> Iterator[list[str]]:
    call: list[str] = []
    chars = 0
    for text in texts:
        call.append(text or "")
        chars += len(call[-1])
        if chars >= _CALL_CHARS:
            yield call
            call, chars = [], 0
    if call:
        yield call


def encoded(texts: list[str | None], folder: str = FOLDER, name: str = NAME, offsets: bool = False) -> Iterator:
    """The library's encoding of each text, with the offsets only where wanted; NULL counts as the empty text."""
    own = tokenizer(folder, name)
    batch = own.encode_batch if offsets else own.encode_batch_fast
    for call in _calls(texts):
        yield from batch(call, add_special_tokens=False)


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(key, ids): the ids of each text, an empty list for an empty and for a NULL text.

    Every row is kept, repeated ones too; other columns are ignored; an empty table gives none.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = [e.ids for e in encoded(batch.column(1).to_pylist(), folder, name)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    rows = spread(documents.select(F.col(key), F.col(text)))
    return rows.mapInArrow(batches, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids array<int>")


def lengths(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(key, size): the number of ids of each text that is neither NULL nor empty."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sizes = [len(e) for e in encoded(batch.column(1).to_pylist(), folder, name)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], names=[key, "size"])

    rows = spread(documents.select(F.col(key), F.col(text)).where(F.length(F.col(text)) > 0))
    return rows.mapInArrow(batches, f"`{key}` {rows.schema[key].dataType.simpleString()}, size int")


def encode_with_offsets(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(key, position, id, start, end): one row per id with the characters of the text it stands for.

    Ids that split one character all have that character's place. NULL and empty texts have no row.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [list(zip(e.ids, *zip(*e.offsets))) if e.ids else [] for e in encoded(batch.column(1).to_pylist(), folder, name, offsets=True)]
            kind = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
            spans = pa.array([[{"id": i, "start": a, "end": b} for i, a, b in x] for x in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=[key, "spans"])

    rows = documents.select(F.col(key), F.col(text))
    spans = rows.mapInArrow(batches, f"`{key}` {rows.schema[key].dataType.simpleString()}, spans array<struct<id:int,start:int,end:int>>")
    flat = spans.select(key, F.posexplode("spans").alias("position", "s"))
    return flat.select(key, "position", "s.id", "s.start", "s.end")


def byte_table() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary, reversed.

    Printable bytes stand for themselves; the others are counted on from code point 256.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {chr(b if b in printable else next(rest)): b for b in range(256)}


@lru_cache(maxsize=4)
def _bytes_of(folder: str, name: str) -> list[bytes]:
    table, vocabulary = byte_table(), tokenizer(folder, name).get_vocab()
    known = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return known


def decoded(ids: list[int] | None, folder: str = FOLDER, name: str = NAME) -> str:
    """The text of ids; characters split over ids come together, ids outside the vocabulary and cut characters give U+FFFD."""
    known = _bytes_of(folder, name)
    return b"".join(known[i] if 0 <= i < len(known) else b"\xff" for i in ids or []).decode("utf-8", errors="replace")


def decode(encodings: DataFrame, key: str = "doc_id", ids: str = "ids", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(key, text): the text of each list of ids; a NULL or empty list gives the empty text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [decoded(x, folder, name) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    rows = encodings.select(F.col(key), F.col(ids))
    return rows.mapInArrow(batches, f"`{key}` {rows.schema[key].dataType.simpleString()}, text string")
