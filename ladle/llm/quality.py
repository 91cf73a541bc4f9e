"""Quality of documents by votes of their nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import text_blocks, texts_of
from ladle.llm.features import bounded_sample, code_points, document_frequencies, gram_counts, inverse_frequencies, sparse_rows

BITS, LONGEST = 12, 3
#: Cells after the n-grams: one term for a text's value range in each of five traits of its form.
TRAITS, RANGES = 5, 16
CELLS = (1 << BITS) + TRAITS * RANGES


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells and counts of a whole text: hashed character n-grams, case and signs kept, and its traits as terms: length,
    share of distinct words, of words that repeat the one before, of capitals and of signs."""
    points = code_points(text)
    total = np.zeros(CELLS, dtype=np.int64)
    total[:1 << BITS] = gram_counts(points, LONGEST, BITS)
    words = text.split()
    n, m = max(1, len(points)), max(1, len(words))
    capitals = int(((points >= 65) & (points <= 90)).sum())
    signs = int(((points > 32) & (points < 48) | (points > 57) & (points < 65) | (points > 90) & (points < 97) | (points > 122) & (points < 127)).sum())
    again = sum(map(str.__eq__, words[1:], words)) / m
    for trait, value in enumerate((np.log2(m + 1) / 16, len(set(words)) / m, again, capitals / n, min(1.0, 4 * signs / n))):
        total[(1 << BITS) + trait * RANGES + min(RANGES - 1, int(value * RANGES))] = 1
    cells = np.flatnonzero(total)
    return cells, total[cells]


@dataclass(frozen=True)
class QualityModel:
    idf: np.ndarray
    projection: np.ndarray  # cells x dimensions
    vectors: np.ndarray  # labelled neighbours, of length 1
    labels: np.ndarray
    neighbours: int
    prior: float


def _dense(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows; a row's n-grams and its traits have length 1 each."""
    out = np.zeros((len(rows), CELLS), dtype=np.float32)
    for i, (cells, counts) in enumerate(rows):
        x = (1 + np.log(counts)) * idf[cells]
        trait = cells >= 1 << BITS
        for part in (~trait, trait):
            x[part] /= max(1e-12, float(np.sqrt(x[part] @ x[part])))
        out[i, cells] = x
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))


def leading_directions(x: np.ndarray, dimensions: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors of x as columns, by subspace iteration: beside x it holds some dozens of
    vectors only, where a full decomposition would hold several squares of the number of rows."""
    width = min(dimensions + 16, *x.shape)
    q = np.random.default_rng(11).standard_normal((x.shape[1], width)).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ np.linalg.qr(x @ q)[0])[0]
    _, values, turned = np.linalg.svd(x @ q, full_matrices=False)
    kept = int((values[:dimensions] > 1e-3).sum())
    return (q @ turned[:max(1, kept)].T).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = 1500, dimensions: int = 64,
        neighbours: int = 20) -> QualityModel:
    """Neighbours from labels (doc_id, label; null labels teach nothing) and the documents' texts.

    Document frequencies cover all docs. The latent space (the leading singular vectors of the TF-IDF rows) and the
    neighbours come from a bounded sample, about per_label rows of each label, whose features come to the driver.
    """
    df, n = document_frequencies(docs, counted, CELLS)
    idf = inverse_frequencies(df, n)
    marked = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = bounded_sample(marked, "label", per_label)
    # the sample is bounded by per_label: documents stay where they are; of a repeated id the least text teaches
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label"))
    sample = sparse_rows(rows, "label", counted)
    y = np.asarray(sample.column("label"), dtype=np.float32)
    pairs = [(np.asarray(c), np.asarray(k)) for c, k in zip(sample.column("cells").to_numpy(), sample.column("counts").to_numpy(), strict=True)]
    if not len(y):
        return QualityModel(idf, np.zeros((CELLS, 1), np.float32), np.zeros((0, 1), np.float32), y, neighbours, 0.5)
    x = _dense(pairs, idf)
    del pairs, sample
    projection = leading_directions(x, dimensions)
    counts = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return QualityModel(idf, projection, _unit(x @ projection), y, neighbours, prior)


def score_documents(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """docs with score, the share of its nearest neighbours' similarity that is labelled 1 (0 to 1).

    Texts go through the latent space in blocks; a block's cosine products with all neighbours are exact. Neighbours
    weigh by the eighth power of their positive cosine. A text with no similar neighbour, and any text if nothing was learned,
    gets the share of label 1 among all labelled rows. Only the text is looked at; a
    null text counts as empty. A column score is replaced, others pass through. The model's size is fixed by its
    parameters.
    """
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double"

    def votes(texts: list[str]) -> np.ndarray:
        if not len(model.labels):
            return np.full(len(texts), model.prior)
        cosine = _unit(_dense([counted(t) for t in texts], model.idf) @ model.projection) @ model.vectors.T
        k = min(model.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(0, np.take_along_axis(cosine, near, axis=1)) ** 8
        for_, all_ = (weight * model.labels[near]).sum(axis=1), weight.sum(axis=1)
        return np.where(all_ > 0, for_ / np.maximum(all_, 1e-12), model.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, limit=2 << 20, text=text):
            texts = texts_of(block, text)
            scores = np.concatenate([votes(texts[i:i + 256]) for i in range(0, len(texts), 256)])
            columns = [block.column(i) for i in range(block.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.clip(scores, 0, 1), pa.float64())], names=[*block.schema.names, "score"])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
