"""Document quality by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import doc_texts, field, release, slices

# Terms: byte trigrams hashed to so many columns, for whole texts.
COLUMNS = 4096
LATENT = 32
NEIGHBOURS = 9
POWER = 4
# Most labelled documents that the model is fitted on and that are broadcast: the first by a hash of
# the id. 6000 latent vectors of 36 floats are under 1 MB; the fit holds 6000 x 4096 halves (48 MB).
LABELLED = 6000
# Documents of one block of the cosine products.
BLOCK = 256
THRESHOLD = 0.3


def term_weights(text: str) -> np.ndarray:
    """log(1 + count) of each hashed trigram of the text's bytes, a line end before and after; zeros for no text."""
    data = np.frombuffer(text and b"\n%b\n" % text.encode("utf-8", "surrogatepass") or b"", np.uint8)
    counts = np.zeros(COLUMNS, np.int64)
    # Parts overlap by two bytes, so no trigram is lost or counted twice.
    for at in range(0, max(len(data) - 2, 0), 1 << 20):
        b = data[at : at + (1 << 20) + 2].astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
        counts += np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(20), minlength=COLUMNS)
    return np.log1p(counts).astype(np.float32)


def shape(text: str) -> np.ndarray:
    """Roots of four shares: words that repeat the one before, capitals, signs and digits among the bytes."""
    words = text.split()
    data = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    total = max(int(data.sum()), 1)
    signs = data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum()
    repeats = sum(map(eq, words, words[1:])) / max(len(words), 1)
    return np.sqrt([repeats, data[65:91].sum() / total, signs / total, data[48:58].sum() / total]).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Votes:
    """What is broadcast: term weights, the latent space, and the labelled vectors in it."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, terms: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        return unit(np.hstack([unit(unit(terms * self.idf) @ self.axes), shapes]))

    def score(self, texts: list[str]) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        terms, shapes = np.stack([term_weights(t) for t in texts]), np.stack([shape(t) for t in texts])
        cosines = self.place(terms, shapes) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        # All that tie with the kth vote, so the order of the labelled rows does not matter.
        kth = np.partition(cosines, -k, axis=1)[:, -k:].min(axis=1, keepdims=True)
        weights = np.where(cosines >= kth, np.maximum(cosines, 0), 0).astype(np.float64) ** POWER
        total = weights.sum(axis=1)
        blank = (total <= 0) | ~terms.any(axis=1)
        return np.where(blank, self.prior, (weights @ self.labels) / np.maximum(total, 1e-300))


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Number of documents with each term, and of all documents; every text is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COLUMNS + 1, np.int64)
        for batch in slices(batches):
            for text in batch.column(0):
                seen[:-1] += term_weights(text.as_py()) > 0
                seen[-1] += 1
        if seen[-1]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(COLUMNS + 1)), pa.array(seen)], names=["term", "documents"]
            )

    counts = docs.select(text_col).mapInArrow(run, "term long, documents long").groupBy("term")
    out = np.zeros(COLUMNS + 1, np.int64)
    for row in counts.agg(F.sum("documents").alias("documents")).collect():
        out[row["term"]] = row["documents"]
    return out[:-1], int(out[-1])


def latent_axes(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Leading right singular vectors, by randomised subspace iteration with a fixed seed."""
    wanted = min(wanted, *rows.shape)
    start = np.random.default_rng(0).standard_normal((rows.shape[1], wanted + 16)).astype(np.float32)
    basis = rows.T @ (rows @ start)
    for _ in range(3):
        basis, _ = np.linalg.qr(basis)
        basis = rows.T @ (rows @ basis)
    basis, _ = np.linalg.qr(basis)
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right.T)[:, :wanted].astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    labelled: int = LABELLED,
) -> Votes:
    """The model: term frequencies of all documents, latent space and vectors of the labelled ones.

    `labels` holds the rows to learn from (`id_col`, `label_col` 0 or 1); nulls and other
    values are left out, of several labels of an id the larger one counts. Only the
    labelled documents are bounded, by `labelled`.
    """
    texts = doc_texts(docs, id_col, text_col)
    frequency, total = document_frequencies(texts, text_col)
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col)
    known = known.agg(F.max(label_col).cast("int").alias("label"))
    # Only ids with a text count for the bound.
    ids = texts.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    chosen = known.join(ids, id_col, "left_semi").orderBy(F.xxhash64(id_col), id_col).limit(labelled)
    pairs = [(r[0], r[1]) for r in chosen.select(id_col, "label").collect()]
    schema = T.StructType([field(texts, id_col), T.StructField("label", T.IntegerType())])
    small = F.broadcast(docs.sparkSession.createDataFrame(pairs, schema))
    sample = texts.join(small, id_col).dropDuplicates([id_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms = [term_weights(t.as_py()).astype(np.float16).tobytes() for t in batch.column(1)]
            shapes = [shape(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(terms, pa.binary()), pa.array(shapes, pa.binary())],
                names=[id_col, "label", "terms", "shape"],
            )

    out = T.StructType(
        [*schema.fields, T.StructField("terms", T.BinaryType()), T.StructField("shape", T.BinaryType())]
    )
    rows = sample.select(id_col, text_col, "label").mapInArrow(run, out).toArrow()
    idf = (np.log((1 + total) / (1 + frequency)) + 0.05).astype(np.float32)
    count = rows.num_rows
    labels_seen = rows.column("label").to_numpy().astype(np.float64)
    if not count:
        return Votes(idf, np.zeros((COLUMNS, 1), np.float32), np.zeros((0, 5), np.float32), labels_seen, 0.5)
    order = pa.compute.sort_indices(rows.column(id_col)).to_pylist()
    labels_seen = labels_seen[order]
    # Row by row and in place: the matrix is the only large thing that the driver holds.
    weighted = np.empty((count, COLUMNS), np.float32)
    shapes = np.empty((count, 4), np.float32)
    for at, row in enumerate(order):
        weighted[at] = np.frombuffer(rows.column("terms")[row].as_py(), np.float16)
        shapes[at] = np.frombuffer(rows.column("shape")[row].as_py(), np.float32)
    del rows
    weighted *= idf
    weighted /= np.maximum(np.sqrt(np.einsum("ij,ij->i", weighted, weighted)), 1e-9)[:, None]
    axes = latent_axes(weighted, LATENT)
    model = Votes(idf, axes, np.zeros((0, 0), np.float32), labels_seen, float(labels_seen.mean()))
    model.vectors = unit(np.hstack([unit(weighted @ axes), shapes])).astype(np.float32)
    del weighted
    release()
    return model


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    labelled: int = LABELLED,
) -> DataFrame:
    """All columns of `docs` with `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Given columns of these names are kept as `score_given` and `predicted_given`.

    Every whole text is compared with every labelled vector, in blocks. A null or empty
    text has the share of label 1 among the labelled documents as its score, and 0.5 if
    nothing is labelled. Ids only pair labels with texts: they, and all other columns,
    never enter a score; repeated rows have equal scores; an empty table gives an empty one.
    """
    for clash in {"score", "predicted"} & set(docs.columns):
        docs = docs.withColumnRenamed(clash, f"{clash}_given")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, labelled))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            texts = [t.as_py() or "" for t in batch.column(names.index(text_col))]
            score = np.clip(model.value.score(texts), 0, 1)
            columns = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "score", "predicted"])

    schema = T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return docs.mapInArrow(run, schema)


def held_out(id_col: str):
    """True for the rows kept apart for testing: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0
