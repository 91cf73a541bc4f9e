"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import text_blocks, texts_of
from ladle.llm.features import bounded_sample, code_points, document_frequencies, gram_counts, inverse_frequencies, sparse_rows

BITS, LONGEST = 15, 3


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = gram_counts(code_points(text.lower()), LONGEST, BITS)
    cells = np.flatnonzero(total)
    return cells, total[cells]


def weighted(cells: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of a document, of length 1; counts are damped by their logarithm."""
    x = (1 + np.log(counts)) * idf[cells]
    return x / max(1e-12, float(np.sqrt(x @ x)))


class Ftrl:
    """Follow-the-regularised-leader with elastic-net penalties for multinomial logistic regression.

    Per coordinate, z holds the summed gradients less the proximal terms and n the summed squared gradients; a weight is
    0 while |z| is within l1, which keeps the model sparse.
    """

    def __init__(self, cells: int, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.001):
        self.z, self.n = np.zeros((cells, classes)), np.zeros((cells, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        scale = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / scale)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax((x @ w)[None, :])[0]
        p[label] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which held-back labels are likeliest (golden-section search of its logarithm)."""
    def loss(t: float) -> float:
        return float(-np.log(np.maximum(1e-12, softmax(logits / np.exp(t))[np.arange(len(labels)), labels])).mean())

    low, high, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float


def fit(rows: DataFrame, label: str = "lang", per_language: int = 600, epochs: int = 3) -> LanguageModel:
    """A model of the rows' labels; rows with a null text or label teach nothing.

    Document frequencies cover all these rows. The classifier learns from a bounded sample, about per_language rows of
    each language: a fifth of it is held back for the temperature. Its features come to the driver, nothing else does.
    """
    rows = rows.filter(F.col("text").isNotNull() & F.col(label).isNotNull())
    df, n = document_frequencies(rows, counted, 1 << BITS)
    idf = inverse_frequencies(df, n)
    sample = sparse_rows(bounded_sample(rows, label, per_language), label, counted)
    named = sample.column("label").to_pylist()
    languages = sorted(set(named))
    x = [(np.asarray(c), weighted(np.asarray(c), np.asarray(k), idf)) for c, k in zip(sample.column("cells").to_numpy(), sample.column("counts").to_numpy(), strict=True)]
    y = np.array([languages.index(v) for v in named], dtype=np.int64)
    rng = np.random.default_rng(7)
    order = rng.permutation(len(y))
    back, teach = order[:len(y) // 5], order[len(y) // 5:]
    model = Ftrl(1 << BITS, max(1, len(languages)))
    for _ in range(epochs):
        for i in rng.permutation(teach):
            if len(x[i][0]):
                model.learn(*x[i], y[i])
    w = model.weights().astype(np.float32)
    logits = np.array([x[i][1] @ w[x[i][0]] for i in back]).reshape(len(back), w.shape[1])
    return LanguageModel(languages, w, idf, temperature(logits, y[back]) if len(back) and len(languages) > 1 else 1.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and score: the likeliest language of each whole text and its calibrated probability.

    `und` with score 0 for a null text, one without a letter (of a Unicode class L; numerals aren't letters), or a model that learned no language. Equal probabilities
    go to the first language by name. Only the text is looked at; columns of these names are replaced. The model's size
    is fixed by its cells and the number of languages.
    """
    kept = [f for f in docs.schema.fields if f.name not in {"lang_pred", "score"}]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, text=text):
            names, scores = [], []
            for t in texts_of(block, text):
                if not model.languages or not any(map(str.isalpha, t)):
                    names.append("und")
                    scores.append(0.0)
                    continue
                cells, counts = counted(t)
                p = softmax((weighted(cells, counts, model.idf) @ model.weights[cells])[None, :] / model.temperature)[0]
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(min(1.0, float(p[best])))
            columns = [block.column(i) for i in range(block.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*block.schema.names, "lang_pred", "score"])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
