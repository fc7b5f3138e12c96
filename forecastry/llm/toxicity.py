"""Operator 2: toxicity by a classifier chain.

The categories are predicted one after the other by linear (logistic) models;
each model sees the words, a few measures of the text's form, and the
probabilities of the categories before it.  So that a later model learns from
predictions like those it will get, the earlier probabilities it is trained on
are *out of fold*: predicted by models that did not see the document.

The models are fitted in numpy on a bounded sample: the ``SAMPLE`` labelled
documents that come first by hash of their id.  The vocabulary is what the
sample associates with a category (chi-square over ``LEAST_CHI2``, at most
``WORDS_PER_CATEGORY`` words each).  A category's limit is the probability with
the best F1 out of fold.  Scoring is one pass over all whole texts, no shuffle.

Edge cases: null or empty text has no words and gets what the intercepts give;
a null label counts as not known and leaves the row out of the sample; an id with
several rows of labels has each label that any of them gives; a labelled id with
several rows of text is one document of the sample, by the text that comes first
by digest; a null id stays null and is never sampled; repeated rows are scored
each; without any labelled document probabilities are null and no flag is set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import checkpointed, id_and_text
from forecastry.llm.decontam import words

SAMPLE = 8_000
FOLDS = 4
WORDS_PER_CATEGORY = 1_024
LEAST_CHI2 = 15.0
LEAST_DOCS = 4
STEPS = 200
RIDGE = 1e-4
FORM = 8  # measures of a text's form


def form(text: str, ws: list[bytes]) -> list[float]:
    """Shares of upper case, digits, symbols, bars, marks and white space, the
    share of distinct words, and the length."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    share = np.bincount(raw, minlength=256) / n
    symbols = sum(share[ord(c)] for c in "#$%&*@^~=+<>")
    return [share[65:91].sum(), share[48:58].sum(), symbols, share[ord("|")], share[ord("!")] + share[ord("?")],
            share[32] + share[10], len(set(ws)) / max(1, len(ws)), np.log1p(len(ws)) / 10]


def features(text: str, vocabulary: dict[bytes, int]) -> tuple[list[int], list[float]]:
    ws = words(text)
    return sorted({vocabulary[w] for w in set(ws) if w in vocabulary}), form(text, ws)


class Linear:
    """Logistic model over present words and dense columns."""

    def __init__(self, n_words: int, n_dense: int):
        self.word, self.dense, self.bias = np.zeros(n_words), np.zeros(n_dense), 0.0

    def logit(self, ptr: np.ndarray, idx: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.word[idx])])
        return sums[ptr[1:]] - sums[ptr[:-1]] + dense @ self.dense + self.bias

    def predict(self, ptr, idx, dense) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(ptr, idx, dense), -30, 30)))

    def fit(self, ptr, idx, dense, y, steps: int = STEPS) -> Linear:
        """Accelerated gradient descent on scaled
        columns; the step comes from the largest curvature, by power iteration."""
        n, row = len(y), np.repeat(np.arange(len(y)), np.diff(ptr))
        use = np.bincount(idx, minlength=len(self.word)) / n
        scale = 1 / np.sqrt(np.sqrt(use) + 0.02)
        mean, deviation = dense.mean(0), dense.std(0)
        deviation = np.where(deviation > 1e-9, deviation, 1.0)
        z, k = (dense - mean) / deviation, len(self.word)

        def forward(w: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum((w[:k] * scale)[idx])])
            return sums[ptr[1:]] - sums[ptr[:-1]] + z @ w[k:-1] + w[-1]

        def back(r: np.ndarray) -> np.ndarray:
            return np.concatenate([np.bincount(idx, r[row], minlength=k) * scale, z.T @ r, [r.sum()]])

        v = np.ones(k + z.shape[1] + 1)
        for _ in range(12):
            v = back(forward(v / np.linalg.norm(v))) / n
        step = 1 / (0.25 * 1.2 * np.linalg.norm(v) + RIDGE)
        w = ahead = np.zeros_like(v)
        t = 1.0
        for _ in range(steps):
            r = 1 / (1 + np.exp(-np.clip(forward(ahead), -30, 30))) - y
            new = ahead - step * (back(r) / n + RIDGE * ahead)
            t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            w, ahead = new, new + (before - 1) / t * (new - w)
        self.word, self.dense = w[:k] * scale, w[k:-1] / deviation
        self.bias = w[-1] - mean @ self.dense
        return self


def _rows_of(ptr, idx, keep) -> tuple[np.ndarray, np.ndarray]:
    """The sparse rows at the positions ``keep``."""
    n = np.diff(ptr)[keep]
    at = np.repeat(ptr[:-1][keep] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return np.concatenate([[0], np.cumsum(n)]), idx[at]


def best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The probability with the best F1."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    k = int(f1.argmax())
    after = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + after) / 2)


def fit_chain(ptr, idx, dense, labels: np.ndarray, n_words: int) -> list[tuple[Linear, float]]:
    """(model, limit) of every category, in chain order; ``labels`` is rows x categories."""
    fold = np.arange(len(labels)) % FOLDS
    chain = []
    for k in range(labels.shape[1]):
        y = labels[:, k]
        out = np.zeros(len(y))
        for f in range(FOLDS):
            seen, unseen = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(seen) and len(unseen):
                m = Linear(n_words, dense.shape[1]).fit(*_rows_of(ptr, idx, seen), dense[seen], y[seen])
                out[unseen] = m.predict(*_rows_of(ptr, idx, unseen), dense[unseen])
        chain.append((Linear(n_words, dense.shape[1]).fit(ptr, idx, dense, y), best_limit(out, y)))
        dense = np.column_stack([dense, out])
    return chain


def _sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return ptr, np.array([i for x in lists for i in x], np.int64)


def fit(df: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text"):
    """(vocabulary, [(model, limit), ...]) from ``labels`` (doc_id and one 0/1
    column a category); None without labelled documents."""
    ys = [f"y{k}" for k in range(len(categories))]
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                          *[F.col(c).cast("double").alias(y) for y, c in zip(ys, categories)]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(y).alias(y) for y in ys])
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # one row an id, however many the table has: at most SAMPLE rows
    docs = checkpointed(
        id_and_text(df, id_col, text_col).join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", *ys).agg(F.min_by("text", F.md5(F.coalesce("text", F.lit("")))).alias("text"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sorted(set(words(t.as_py() or ""))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(y) for y in ys), pa.array(got, pa.list_(pa.binary()))], names=[*ys, "w"]
            )

    schema = ", ".join(f"{y} double" for y in ys)
    per_word = docs.mapInArrow(split, f"{schema}, w array<binary>").select(*ys, F.explode("w").alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(y).alias(y) for y in ys]
    ).where(F.col("n") >= LEAST_DOCS)
    whole = docs.agg(F.count(F.lit(1)), *[F.sum(y) for y in ys]).first()
    if not whole[0]:
        return None
    total, vocabulary = float(whole[0]), set()
    for y, positives in zip(ys, whole[1:], strict=True):
        expected = F.col("n") * positives / total
        chi2 = (F.col(y) - expected) ** 2 / (expected * (1 - positives / total) * (1 - F.col("n") / total) + 1e-9)
        best = per_word.where(chi2 > LEAST_CHI2).orderBy(chi2.desc(), "w").limit(WORDS_PER_CATEGORY)
        vocabulary |= {bytes(r.w) for r in best.select("w").collect()}
    vocabulary = {w: i for i, w in enumerate(sorted(vocabulary))}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t.as_py() or "", vocabulary) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(y) for y in ys), pa.array([w for w, _ in got], pa.list_(pa.int64())),
                 pa.array([d for _, d in got], pa.list_(pa.float64()))], names=["doc_id", *ys, "w", "d"]
            )

    rows = sorted(docs.mapInArrow(featured, f"doc_id long, {schema}, w array<long>, d array<double>").collect())
    ptr, idx = _sparse([r.w for r in rows])
    y = np.array([[r[c] for c in ys] for r in rows])
    chain = fit_chain(ptr, idx, np.array([r.d for r in rows]), y, len(vocabulary))
    return vocabulary, [(m.word, m.dense, m.bias, limit) for m, limit in chain]


def predict_chain(ptr, idx, dense, chain) -> list[tuple[np.ndarray, float]]:
    """(probabilities, limit) of every category."""
    out = []
    for word, weights, bias, limit in chain:
        m = Linear(len(word), len(weights))
        m.word, m.dense, m.bias = word, weights, bias
        p = m.predict(ptr, idx, dense)
        out.append((p, limit))
        dense = np.column_stack([dense, p])
    return out


def score(
    df: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and, for every category, p_<category> (six digits) and is_<category>."""
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, categories, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch, columns = whole.slice(k, 2000), []
                if model.value is None:
                    for _ in categories:
                        columns += [pa.nulls(batch.num_rows, pa.float64()), pa.array([False] * batch.num_rows)]
                else:
                    vocabulary, chain = model.value
                    got = [features(t.as_py() or "", vocabulary) for t in batch.column("text")]
                    ptr, idx = _sparse([w for w, _ in got])
                    for p, limit in predict_chain(ptr, idx, np.array([d for _, d in got]).reshape(-1, FORM), chain):
                        columns += [pa.array(np.round(p, 6)), pa.array(p > limit)]
                names = [f"{x}_{c}" for c in categories for x in ("p", "is")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"p_{c} double, is_{c} boolean" for c in categories)
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)
