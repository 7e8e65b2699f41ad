"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries meet again."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import doc_texts, field, slices, text_key
from riskloom.session import materialize, ship_package

# Characters of a chunk of a text that is exchanged, and how far it reaches into the next one.
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
# The same inside one task, for every text.
SCAN_CHARS = 1 << 11
SCAN_OVERLAP = 1 << 8
# The longest alternative of the pattern with a fixed text ("'ll"), so much is looked at past a boundary.
_AHEAD = 3
# Ids that are turned into bytes at a time.
_PART = 1 << 16


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder for a rank file; loaded once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, by position."""
    with open(path, "rb") as lines:
        known = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [known[i] for i in range(len(known))]


@lru_cache(maxsize=2)
def token_digits(path: str) -> list[bytes]:
    """Each id in decimal digits, with a blank behind."""
    return [b"%d " % i for i in range(len(token_bytes(path)))]


def joined(ids: np.ndarray, table: list[bytes]) -> Iterator[bytes]:
    """The table's entries for the ids one after the other, a bounded part at a time."""
    for at in range(0, len(ids), _PART):
        yield b"".join(map(table.__getitem__, ids[at : at + _PART].tolist()))


def lists(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The rows of an Arrow list column as arrays, without a Python object per item."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    for row, known in enumerate(column.is_valid().to_pylist()):
        yield flat[ends[row] : ends[row + 1]] if known else None


def ids_digest(ids: np.ndarray, path: str) -> str:
    """SHA-256 of the decimal ids, joined by one blank."""
    digest, held = hashlib.sha256(), b""
    for part in joined(ids, token_digits(path)):
        digest.update(held)
        held = part
    digest.update(held[:-1])
    return digest.hexdigest()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def stitched(text: str, pattern: regex.Pattern, size: int = SCAN_CHARS, overlap: int = SCAN_OVERLAP) -> list[str]:
    """The text cut where the scans of overlapping chunks agree; in one piece if some never do."""
    begin, cuts = 0, []
    for at in range(0, len(text) - size, size):
        till = meeting(text[at : at + size + overlap], size, pattern)
        if till < 0:
            return [text]
        cuts.append(text[begin : at + till])
        begin = at + till
    return [*cuts, text[begin:]]


def _encode(rows: DataFrame, keep: list[str], path: str, pattern: str) -> DataFrame:
    """`keep`, `ids` for the column `text` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, compiled = encoding(path, pattern).encode_ordinary, regex.compile(pattern)
        for batch in slices(batches):
            texts = batch.column(len(keep))
            ids = [np.array([i for x in stitched(t.as_py(), compiled) for i in encode(x)], np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), _lists(ids)], names=[*keep, "ids"]
            )

    schema = T.StructType([*(field(rows, c) for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.select(*keep, "text").mapInArrow(run, schema)


def meeting(text: str, start: int, pattern: regex.Pattern) -> int:
    """Where a scan of `text` and one that only begins at `start` have their first safe boundary in common.

    From there on they agree, as a match looks at nothing before it. A boundary is safe
    if it does not hang on what follows the text, and no white space stands before it:
    then the text up to it has the same matches when it is cut there. -1 if there is none.
    """
    last = len(text) - _AHEAD
    ends = {m.end() for m in pattern.finditer(text) if m.end() > start}
    for match in pattern.finditer(text, start):
        at = match.end()
        if match.start() > last or at > last:
            break
        if at in ends and not text[at - 1].isspace():
            return at
    return -1


def _chunks(rows: DataFrame, key: list[str], size: int, overlap: int) -> DataFrame:
    """One row per chunk: the key, `no`, `last` and the chunk's text with its overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            text = batch.column(len(key))[0].as_py()
            count = -(-len(text) // size)
            for no in range(count):
                keys = [batch.column(i) for i in range(len(key))]
                part = text[no * size : (no + 1) * size + overlap]
                values = [pa.array([no], pa.int32()), pa.array([no == count - 1]), pa.array([part])]
                yield pa.RecordBatch.from_arrays(keys + values, names=[*key, "no", "last", "text"])

    schema = T.StructType(
        [
            *(field(rows, c) for c in key),
            T.StructField("no", T.IntegerType()),
            T.StructField("last", T.BooleanType()),
            T.StructField("text", T.StringType()),
        ]
    )
    return rows.select(*key, "text").mapInArrow(run, schema)


def _scan(chunks: DataFrame, size: int, pattern: str) -> DataFrame:
    """Chunks with `till`: where the next chunk takes over, counted in this chunk; -1 if the scans never meet."""
    names = chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in slices(batches):
            rows = zip(batch.column(names.index("last")).to_pylist(), batch.column(names.index("text")))
            till = [len(t.as_py()) if last else meeting(t.as_py(), size, compiled) for last, t in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(till, pa.int32())], names=[*names, "till"])

    return chunks.mapInArrow(run, T.StructType([*chunks.schema.fields, T.StructField("till", T.IntegerType())]))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """`id_col`, `ids` (array of int) for every row: the ordinary BPE ids of the whole text.

    Texts are cut into overlapping chunks, which are pre-tokenised each for itself; each
    chunk hands over to the next at the first boundary on which both agree inside the
    overlap, and the pieces between these places are encoded and put together. Texts of
    up to `chunk_chars` are cut, scanned and encoded where they are read; longer ones are
    exchanged in chunks of that size first, so that many tasks share them. If the scans of some overlap never meet (a word longer than the overlap), the text is encoded in
    one piece, so the result never depends on the cut.

    A null text is empty and has no ids; null ids and repeated rows stay; an empty
    table gives an empty result; other columns are ignored.
    """
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must be positive and no longer than a chunk")
    rows = doc_texts(docs, id_col, text_col).select(id_col, F.col(text_col).alias("text"))
    short = _encode(rows.where(F.length("text") <= chunk_chars), [id_col], path, pattern)

    key = [id_col, "h1", "h2"]
    long = rows.where(F.length("text") > chunk_chars).select(id_col, *text_key("text"), "text")
    # Rows that repeat an id with its text are encoded once and counted.
    parts = _chunks(long, key, chunk_chars, overlap_chars).groupBy(*key, "no").agg(
        F.first("last").alias("last"), F.first("text").alias("text"), F.count("*").alias("copies")
    )
    scanned = materialize(_scan(parts, chunk_chars, pattern), "chunks")
    whole = Window.partitionBy(*key)
    cut = scanned.withColumns(
        {
            "broken": F.min("till").over(whole) < 0,
            "begin": F.lag("till", 1).over(whole.orderBy("no")) - F.lit(chunk_chars),
        }
    )
    text = F.when(F.col("broken"), F.substring("text", 1, chunk_chars)).otherwise(
        F.expr("substring(text, coalesce(begin, 0) + 1, till - coalesce(begin, 0))")
    )
    cut = cut.select(*key, "no", "copies", "broken", text.alias("text"))
    pieces = _encode(
        cut.where(~F.col("broken")).repartition(*key, "no"), [*key, "no", "copies"], path, pattern
    )
    unbroken = (
        cut.where("broken")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("no", "text"))).alias("t"), F.max("copies").alias("copies"))
        .select(*key, F.lit(0).alias("no"), "copies", F.array_join(F.col("t.text"), "").alias("text"))
    )
    stitched = (
        pieces.union(_encode(unbroken, [*key, "no", "copies"], path, pattern))
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("t"), F.max("copies").alias("copies"))
        .select(id_col, F.flatten(F.col("t.ids")).alias("ids"), "copies")
        .withColumn("copies", F.explode(F.expr("sequence(1L, copies)")))
        .select(id_col, "ids")
    )
    return short.union(stitched)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of its ids in `out_col`; null ids give null. An id that the file lacks is an error."""
    ship_package(encoded.sparkSession)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = lists(batch.column(names.index(ids_col)))
            out = [None if x is None else b"".join(joined(x, token_bytes(path))) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, out_col])

    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())])
    return encoded.mapInArrow(run, schema)
