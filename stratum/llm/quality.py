"""Quality classifier: supervised subword embeddings.

Every word and every byte 3- and 4-gram of a word (a space next to it marks its
border) is hashed to a bucket, and so is the distance at which a word repeats one of
the words just before it (a word n-gram without its words); each bucket has a learned
vector.  A document is
the average of the vectors of all its features, followed by a softmax layer over
the two classes.  Vectors and layer are trained together by numpy stochastic
gradient descent (mini-batches, linearly falling rate) on a bounded sample of
labelled documents outside the held-out fold.

Scoring needs only the product of each bucket's vector with the layer (one float
per bucket), so the model that travels to the tasks is ``2**BUCKET_BITS`` floats.

Scale: training reads the sample (at most ``sample`` documents) through a
broadcast join of bounded size; scoring is one narrow pass without a shuffle.

Defined results: null and empty texts have no features, their vector is zero and
their score is the prior that the softmax bias learnt.  Labels, lang, source and
doc_id are never features.  Repeated rows give repeated results.  Without any
training label (or with one class only) the bias alone decides: the smoothed
share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import sampling
from stratum.llm.frames import carried, released, tidy

BUCKET_BITS = 16
GRAMS = (3, 4)
BACK = 16  # words looked back for a repetition
REPEAT_BUCKET = 7  # the first of BACK + 1 buckets for word bigrams "again, d words later"


def feature_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document row) arrays: words first, then each gram size."""
    from stratum.llm.textops import NON_SPACE, U, Words, prefix_hash, span_hash

    n = len(offsets) - 1
    words = Words(data, offsets, NON_SPACE, hashes=False)
    code = span_hash(prefix_hash(data), words.start, words.end)
    yield (code >> U(64 - BUCKET_BITS)).astype(np.int32), words.doc
    near = np.zeros(len(words), dtype=np.int32)  # distance to the same word just before, or 0
    for d in range(BACK, 0, -1):
        near[d:][(code[d:] == code[:-d]) & (words.doc[d:] == words.doc[:-d])] = d
    yield (near + REPEAT_BUCKET).astype(np.int32), words.doc
    doc = np.repeat(np.arange(n), np.diff(offsets))
    solid = NON_SPACE[data]
    wide = data.astype(np.uint32)
    for k in GRAMS:
        m = len(data) - k + 1
        if m <= 0:
            continue
        ok = doc[:m] == doc[k - 1:]
        for i in range(1, k - 1):
            ok &= solid[i:i + m]
        key = wide[:m].copy()
        for i in range(1, k):
            key |= wide[i:i + m] << np.uint32(8 * i)
        key = (key + np.uint32(k)) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x85EBCA77)
        yield (key >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)[ok], doc[:m][ok]


@dataclass
class Model:
    bucket: np.ndarray  # logit of each bucket's vector
    bias: float

    def score(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        z = total / np.maximum(count, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int = 8,
          epochs: int = 12, rate: float = 2.0, batch: int = 64, least_steps: int = 500,
          seed: int = 7) -> Model:
    """``bags``: (distinct buckets, counts) of each document."""
    rng = np.random.RandomState(seed)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(share / (1 - share))))
    vec = rng.uniform(-1, 1, size=(1 << BUCKET_BITS, dim)).astype(np.float32) / dim
    layer = rng.normal(0, 0.1, size=(2, dim)).astype(np.float32)
    bias = np.log(np.array([1 - share, share])).astype(np.float32)
    size = np.array([len(i) for i, _ in bags])
    weight = [(c / c.sum()).astype(np.float32) for _, c in bags]
    per_epoch = -(-len(y) // batch)
    epochs = max(epochs, -(-least_steps // per_epoch))  # small samples are passed more often
    steps, done = epochs * per_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            lr = rate * (1 - done / steps)
            done += 1
            rows = [r for r in order[at:at + batch] if size[r]]
            if not rows:
                continue
            idx = np.concatenate([bags[r][0] for r in rows])
            w = np.concatenate([weight[r] for r in rows])
            starts = np.concatenate([[0], np.cumsum(size[rows])[:-1]])
            hidden = np.add.reduceat(vec[idx] * w[:, None], starts, axis=0)
            logit = hidden @ layer.T + bias
            logit -= logit.max(axis=1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1.0  # gradient of the cross entropy
            back = p @ layer
            layer -= lr / len(rows) * (p.T @ hidden)
            bias -= lr / len(rows) * p.sum(axis=0)
            g = np.repeat(back, size[rows], axis=0) * w[:, None]
            for d in range(dim):
                vec[:, d] -= lr * np.bincount(idx, weights=g[:, d], minlength=len(vec)).astype(np.float32)
    diff = layer[1] - layer[0]
    return Model((vec @ diff).astype(np.float64), float(bias[1] - bias[0]))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from stratum.llm.textops import blocks, flat

    for b in batches:
        data, off = flat(b.column("text"))
        for i, j in blocks(off):
            part, bounds = data[off[i]:off[j]], off[i:j + 1] - off[i]
            runs = list(feature_runs(part, bounds))
            key = np.concatenate([(doc << BUCKET_BITS) | f for f, doc in runs])
            key, count = np.unique(key, return_counts=True)
            cut = np.searchsorted(key, np.arange(j - i + 1) << BUCKET_BITS)
            low = (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
            count = count.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("y").slice(i, j - i),
                 pa.array([low[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:])], pa.binary()),
                 pa.array([count[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["y", "buckets", "counts"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 3000, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality", modulus: int = 4,
                remainder: int = 2) -> Model:
    """Train on at most ``sample`` labelled documents, half of each class at most."""
    known = sampling.labelled(labels, label_col, id_col, modulus, remainder)
    chosen = None
    for y in (0, 1):
        part = sampling.sample_rows(known.filter(F.col("y") == y), id_col, sample // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    share = known.agg(F.avg("y")).first()[0]
    rows = sampling.texts_of(docs, chosen, id_col, text_col).select("y", "text").mapInArrow(
        tidy(_bags), "y int, buckets binary, counts binary").toArrow()
    got = sorted(zip(rows["y"].to_pylist(), rows["buckets"].to_pylist(), rows["counts"].to_pylist()))
    bags = [(np.frombuffer(i, np.int32), np.frombuffer(c, np.int32)) for _, i, c in got]
    y = np.array([g[0] for g in got], dtype=np.int64)
    model = train(bags, y)
    if len(set(y.tolist())) == 2:  # the sample is balanced; the corpus is not
        seen = y.mean()
        share = min(max(share, 0.01), 0.99)
        model.bias += float(np.log(share / (1 - share)) - np.log(seen / (1 - seen)))
    return model


def _scores(m: Model, column: pa.Array) -> np.ndarray:
    from stratum.llm.textops import blocks, flat

    data, off = flat(column)
    total, count = np.zeros(len(off) - 1), np.zeros(len(off) - 1)
    for i, j in blocks(off):
        for f, doc in feature_runs(data[off[i]:off[j]], off[i:j + 1] - off[i]):
            total[i:j] += np.bincount(doc, weights=m.bucket[f], minlength=j - i)
            count[i:j] += np.bincount(doc, minlength=j - i)
    return m.score(total, count)


def keep_quality(docs: DataFrame, model: Model, threshold: float = 0.7,
                 text_col: str = "text") -> DataFrame:
    """The rows that the classifier accepts, with all their columns (one narrow pass)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket, model.bias))

    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        m = Model(*shared.value)
        for b in batches:
            text = pc.struct_field(b.column("row"), [at])
            # Block by block, so that no second copy of a whole batch is held.
            for i, j in blocks(flat(text)[1]):
                yield b.slice(i, j - i).filter(pa.array(_scores(m, text.slice(i, j - i)) >= threshold))

    rows = carried(docs)
    kept = rows.mapInArrow(tidy(run), rows.schema)
    return released(kept, docs.columns)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
                  text_col: str = "text", modulus: int = 4, remainder: int = 2) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            s = _scores(m, b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array(s),
                 pa.array((s >= threshold).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"),
                       sampling.held_out(id_col, modulus, remainder).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
