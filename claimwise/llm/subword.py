"""Quality classifier with supervised subword embeddings.

A document is the mean of the vectors of its words and word pairs plus the mean of the vectors of its character
n-grams (bytes of the UTF-8 text), both hashed into buckets; a softmax layer on top gives the classes.  Vectors and layer are
learned together by stochastic gradient descent in numpy, on a bounded sample of labelled documents whose
hashed counts (not texts) come to the driver.  A word that repeats its predecessor makes the same pair feature for all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import WordHashes, mixed, short_batches

#: Expected number of training documents per class: the bound of the labelled sample.
SAMPLE_DOCS = 1200
WORD_BUCKETS = CHAR_BUCKETS = 1 << 14
GRAMS = (3, 4)
SIZE = 12
EPOCHS = 8
RATE = 0.5
PAIR = np.uint64(0xD6E8FEB86659FD93)
SAME = 0  # the bucket of a word equal to the one before it


def features(text: str | None, words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs, and of all character n-grams, of a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    h = words.of(data.split())
    pairs = mixed(h[:-1] * PAIR + h[1:]) >> np.uint64(50)
    same = h[:-1] == h[1:]
    word_ids = np.concatenate((mixed(h) >> np.uint64(50), np.where(same, np.uint64(SAME), pairs))).astype(np.int32)
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    grams = []
    for n in GRAMS:
        if len(raw) >= n:
            x = np.full(len(raw) - n + 1, n, np.uint64)
            for k in range(n):
                x = (x << np.uint64(8)) | raw[k:len(raw) - n + 1 + k]
            grams.append((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50))
    char_ids = np.concatenate(grams).astype(np.int32) if grams else np.empty(0, np.int32)
    return word_ids, char_ids


def shares(ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their share of all ids."""
    n = np.bincount(ids, minlength=buckets) if len(ids) else np.zeros(0, np.int64)
    found = np.flatnonzero(n)
    return found.astype(np.int32), (n[found] / max(1, len(ids))).astype(np.float32)


class Model:
    """Bucket vectors, softmax layer and the classes' log prior odds against the sample's."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (WORD_BUCKETS + CHAR_BUCKETS, SIZE)).astype(np.float32)
        self.layer = np.zeros((SIZE, 2), np.float32)
        self.bias = np.zeros(2, np.float64)

    def train(self, docs: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 11) -> None:
        """``docs``: buckets, weights and class of each document; one step per document, falling rate."""
        rng = np.random.default_rng(seed)
        steps, done = EPOCHS * len(docs), 0
        for _ in range(EPOCHS):
            for i in rng.permutation(len(docs)):
                ids, weights, label = docs[i]
                rate = RATE * (1 - done / steps)
                done += 1
                hidden = weights @ self.vectors[ids] if len(ids) else np.zeros(SIZE, np.float32)
                z = hidden @ self.layer + self.bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[label] -= 1.0
                back = self.layer @ p.astype(np.float32)
                self.layer -= rate * np.outer(hidden, p).astype(np.float32)
                self.bias -= 0.1 * rate * p
                if len(ids):
                    # shares are small numbers: the vectors' own rate makes up for it
                    self.vectors[ids] -= 20 * rate * weights[:, None] * back

    def folded(self) -> tuple[np.ndarray, np.ndarray, float]:
        """For two classes the softmax needs one number a bucket: its vector times the layer's difference."""
        pull = self.vectors @ (self.layer[:, 1] - self.layer[:, 0])
        return pull[:WORD_BUCKETS], pull[WORD_BUCKETS:], float(self.bias[1] - self.bias[0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Learn from ``labels`` (``id_col``, ``label_col`` 0 or 1; null labels are passed over) and the texts of ``docs``.

    About ``SAMPLE_DOCS`` of each class are drawn by hash of the id; classes are learned evenly and their true shares
    enter as the prior.  Without any label the score is one half everywhere."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)")
    n = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if n:
        rate = F.lit(0.0)
        for label, count in n.items():
            rate = F.when(F.col("label") == label, F.lit(min(1.0, SAMPLE_DOCS / count))).otherwise(rate)
        chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
        sample = own.filter(chance < rate)  # about SAMPLE_DOCS rows a class: small enough to broadcast

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            words = WordHashes()
            for df in batches:
                out = []
                for i, text, label in zip(df["id"], df["text"], df["label"], strict=True):
                    w, c = features(text, words)
                    (wi, ws), (ci, cs) = shares(w, WORD_BUCKETS), shares(c, CHAR_BUCKETS)
                    ids = np.concatenate((wi, ci + WORD_BUCKETS)).astype(np.uint16)
                    out.append((i, label, ids.tobytes(), np.concatenate((ws, cs)).astype(np.float32).tobytes()))
                yield pd.DataFrame(out, columns=["id", "label", "ids", "weights"])

        short_batches(docs.sparkSession)
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        kind = texts.schema["id"].dataType.simpleString()
        got = (texts.join(F.broadcast(sample), "id").mapInPandas(count, f"id {kind}, label int, ids binary, weights binary")
               .orderBy("id", "label").toPandas())
        rows = [(np.frombuffer(i, np.uint16).astype(np.int64), np.frombuffer(w, np.float32), int(x))
                for i, w, x in zip(got["ids"], got["weights"], got["label"], strict=True)]
        if rows:
            model.train(rows)
            seen = np.bincount([r[2] for r in rows], minlength=2) + 1.0
            true = np.array([n.get(0, 0), n.get(1, 0)]) + 1.0
            model.bias += np.log(true / seen)
    return model.folded()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with one added struct column ``into``: ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``
    (1 from 0.5 on, else 0).

    Null and empty texts have no features: they get the classes' prior; blank ones have n-grams of their blanks only.  Texts are read whole; a row's result depends on
    its text alone, so repeated rows agree; an empty table gives an empty result; other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number a bucket

    @F.pandas_udf("score double, predicted int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_word, by_gram, bias = shared.value
        words = WordHashes()
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                w, c = features(text if isinstance(text, str) else None, words)
                z = bias + (by_word[w].mean(dtype=np.float64) if len(w) else 0.0) + (by_gram[c].mean(dtype=np.float64) if len(c) else 0.0)
                out[k] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pd.DataFrame({"score": out, "predicted": (out >= 0.5).astype(np.int32)})

    short_batches(docs.sparkSession)
    return docs.withColumn(into, run(F.col(f"`{text_col}`")))
