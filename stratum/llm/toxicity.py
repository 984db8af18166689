"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other training text, whatever it
holds, is unlabelled.  With class prior p the risk of a classifier g is estimated
without negatives (the class-prior-corrected estimator):

    R(g) = p R_P+(g) + max(0, R_U-(g) - p R_P-(g))

The maximum keeps the estimate of the negatives' risk from running below zero, which is
how a classifier that sees no negatives overfits; its corner is rounded, so that a
quasi-Newton descent finds the least risk.  The classifier is linear with the logistic
loss over hashed distinct lower-case words (a single word marks a long document as well as
a short one), with an L2 term, on the words whose shares among positives and unlabelled
texts differ significantly.  The prior is the share of confirmed toxic documents among
the labelled ones of the training folds.

Scale.  Confirmed positives are a bounded sample of labelled rows (``positives``).  The
unlabelled side is all rows of the training folds, in two narrow passes and one small
aggregate per step: word shares over all distinct texts (one count per bucket), then every
text reduced to the significant words it holds, equal reductions counted together, then
for each step of a quasi-Newton descent the sums of risk and gradient over these rows.
Sums are added as integers (2**-20 steps), so their order does not matter.  The driver
holds one number per bucket; scoring is one narrow pass with ``2**BUCKET_BITS`` floats.

Defined results: null and empty texts have no words, their score comes from the
bias.  Labels, lang, source and doc_id are never features.  Repeated rows give
repeated results.  Without any confirmed toxic example the score is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import sampling
from stratum.llm.frames import may_contain, stored, tidy

BUCKET_BITS = 18
DECAY = 1e-4      # of the L2 term
SMOOTH = 0.005    # width of the corner of max(0, negative part)
UNIT = 1 << 20    # sums over all rows are added as integers of 1 / UNIT


@dataclass
class Model:
    weight: np.ndarray
    bias: float


def distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document row), each pair once."""
    from stratum.llm.textops import ALNUM, U, Words

    words = Words(data, offsets, ALNUM)
    key = np.unique((words.doc << BUCKET_BITS)
                    | (words.code >> U(64 - BUCKET_BITS)).astype(np.int64))
    return key & ((1 << BUCKET_BITS) - 1), key >> BUCKET_BITS


class _Bags:
    """Documents as rows of a sparse 0/1 matrix over the buckets in use."""

    def __init__(self, rows: list[np.ndarray]):
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.idx = np.concatenate(rows)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[rows]
        stop = np.cumsum(size)
        pos = np.repeat(self.at[rows] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)
        return self.idx[pos], np.repeat(np.arange(len(rows)), size)

    def sums(self, w: np.ndarray, count: np.ndarray, of) -> tuple[np.ndarray, np.ndarray]:
        """(score of every row, gradient of sum(count * f) for f' = ``of(score)``)."""
        idx, row = self.take(np.arange(len(self.size)))
        z = np.bincount(row, weights=w[idx], minlength=len(self.size)) + w[-1]
        d = count * of(z)
        g = np.bincount(idx, weights=d[row], minlength=len(w)).astype(float)
        g[-1] += d.sum()
        return z, g


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _once(rows: list[np.ndarray]) -> list[np.ndarray]:
    return [np.frombuffer(r, dtype=np.int64) for r in sorted({r.tobytes() for r in rows})]


def significant(in_pos: np.ndarray, n_pos: int, in_unl: np.ndarray, n_unl: int,
                least_z: float = 4.0) -> np.ndarray:
    """Buckets whose shares in both samples differ by ``least_z`` standard errors or more:
    single rare words cannot be told from chance."""
    pooled = (in_pos + in_unl + 1) / (n_pos + n_unl + 2)
    z = (in_pos / n_pos - in_unl / n_unl) / np.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))
    return np.flatnonzero(np.abs(z) >= least_z)


def minimise(positive: _Bags, unlabelled_risk, n: int, prior: float, steps: int = 40,
             decay: float = DECAY) -> np.ndarray:
    """Weights (the bias last) of least risk, by limited-memory quasi-Newton steps.

    ``unlabelled_risk(w)`` gives the mean of R_U- and its gradient over all unlabelled rows.
    """
    once = np.full(len(positive.size), 1.0 / len(positive.size))

    def risk(w):
        risk_u, grad_u = unlabelled_risk(w)
        z, grad_neg = positive.sums(w, once, _sigmoid)
        _, grad_pos = positive.sums(w, once, lambda z: -_sigmoid(-z))
        rest = risk_u - prior * np.logaddexp(0, z).mean()
        # SMOOTH * log(1 + exp(rest / SMOOTH)): max(0, rest) with a rounded corner.
        value = prior * np.logaddexp(0, -z).mean() + SMOOTH * np.logaddexp(0, rest / SMOOTH)
        grad = prior * grad_pos + _sigmoid(rest / SMOOTH) * (grad_u - prior * grad_neg)
        return (value + 0.5 * decay * float((w[:-1] ** 2).sum()), grad + np.append(decay * w[:-1], 0.0))

    w = np.zeros(n)
    w[-1] = np.log(prior / (1 - prior))
    value, grad = risk(w)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < steps:
        d, alphas = grad.copy(), []
        for s, y in reversed(moves):
            alphas.append(float(s @ d) / float(s @ y))
            d -= alphas[-1] * y
        if moves:
            s, y = moves[-1]
            d *= float(s @ y) / float(y @ y)
        else:
            d /= max(1e-12, float(np.abs(grad).max()))
        for (s, y), alpha in zip(moves, reversed(alphas)):
            d += s * (alpha - float(y @ d) / float(s @ y))
        slope, t = float(grad @ d), 1.0
        if slope <= 1e-12:
            break
        better = False
        while used < steps and not better:
            new_value, new_grad = risk(w - t * d)
            used += 1
            better = new_value <= value - 1e-4 * t * slope
            t = t if better else 0.4 * t
        if not better:
            break
        s, y = -t * d, new_grad - grad
        if float(s @ y) > 1e-14:
            moves = [*moves, (s, y)][-10:]
        gain, w, value, grad = value - new_value, w + s, new_value, new_grad
        if gain < 1e-8:
            break
    return w


def _compact(rows: list[np.ndarray], used: np.ndarray) -> _Bags:
    column = np.full(1 << BUCKET_BITS, -1, dtype=np.int64)
    column[used] = np.arange(len(used))
    return _Bags([c[c >= 0] for c in (column[r] for r in rows)])


def _model(w: np.ndarray, used: np.ndarray) -> Model:
    weight = np.zeros(1 << BUCKET_BITS)
    weight[used] = w[:-1]
    return Model(weight, float(w[-1]))


def _held(prior: float | None) -> float:
    return float(min(max(0.1 if prior is None else prior, 1e-3), 0.95))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Both sides as arrays of distinct buckets in memory; equal rows count once in the shares."""
    prior = _held(prior)
    if not positive or not unlabelled:
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(prior / (1 - prior))))
    count = lambda rows: np.bincount(np.concatenate(rows), minlength=1 << BUCKET_BITS)
    a, b = _once(positive), _once(unlabelled)
    used = significant(count(a), len(a), count(b), len(b))
    rows = _compact(unlabelled, used)
    share = np.full(len(unlabelled), 1.0 / len(unlabelled))

    def risk(w):
        z, g = rows.sums(w, share, _sigmoid)
        return float(np.logaddexp(0, z).mean()), g

    return _model(minimise(_compact(positive, used), risk, len(used) + 1, prior), used)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from stratum.llm.textops import blocks, flat

    for b in batches:
        data, off = flat(b.column("text"))
        for i, j in blocks(off):
            f, doc = distinct_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
            cut = np.searchsorted(doc, np.arange(j - i + 1))
            f = f.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("y").slice(i, j - i),
                 pa.array([f[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["y", "buckets"])


def _share_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(texts that hold each bucket, texts) over the distinct texts of (th, text) rows.

    Only texts that occur more than once leave their scan to be counted once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        total, n = np.zeros(1 << BUCKET_BITS, dtype=np.int64), 0
        for b in batches:
            data, off = flat(b.column("text"))
            n += len(off) - 1
            for i, j in blocks(off):
                total += np.bincount(distinct_words(data[off[i]:off[j]], off[i:j + 1] - off[i])[0],
                                     minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))],
                                         names=["bucket", "n"])

    again = stored(texts.groupBy("th").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("th"), "again")
    marked = may_contain(texts, "th", again, mark="met")
    once = marked.filter("NOT met").select("text").unionByName(
        marked.filter("met").groupBy("th").agg(F.first("text").alias("text")).select("text"))
    rows = once.mapInArrow(tidy(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    out[bucket[bucket >= 0]] = n[bucket >= 0]
    return out, int(n[bucket < 0].sum())


def _reduced(texts: DataFrame, used: np.ndarray) -> DataFrame:
    """(words, n): the significant words of every text (indexes, binary), equal ones counted."""
    column = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    shared = texts.sparkSession.sparkContext.broadcast(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        for b in batches:
            data, off = flat(b.column("text"))
            for i, j in blocks(off):
                f, doc = distinct_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                c = shared.value[f]
                c, doc = c[c >= 0], doc[c >= 0]
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.sort(c[p:q]).tobytes() for p, q in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["words"])

    return texts.select("text").mapInArrow(tidy(run), "words binary").groupBy("words").agg(
        F.count(F.lit(1)).alias("n"))


def _risk_over(rows: DataFrame, total: int, n: int):
    """w -> (mean of R_U-, its gradient) over all ``rows``, one aggregate job a call."""
    def risk(w: np.ndarray) -> tuple[float, np.ndarray]:
        shared = rows.sparkSession.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grad, value = np.zeros(n), 0.0
            for b in batches:
                bags = _Bags([np.frombuffer(x, np.int32).astype(np.int64) for x in b.column("words").to_pylist()])
                count = b.column("n").to_numpy().astype(float)
                z, g = bags.sums(shared.value, count, _sigmoid)
                grad += g
                value += float((count * np.logaddexp(0, z)).sum())
            sums = np.rint(np.append(grad, value) * UNIT).astype(np.int64)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["i", "v"])

        got = rows.mapInArrow(tidy(run), "i long, v long").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(n + 1)
        out[got["i"].to_numpy()] = got["v"].to_numpy() / (UNIT * total)
        shared.unpersist()
        return float(out[-1]), out[:-1]

    return risk


def fit_toxicity(docs: DataFrame, labels: DataFrame, positives: int = 3000, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic", modulus: int = 5,
                 remainder: int = 0) -> Model:
    """Train on at most ``positives`` confirmed toxic texts and all texts of the training folds."""
    known = sampling.labelled(labels, label_col, id_col, modulus, remainder)
    prior = _held(known.agg(F.avg("y")).first()[0])
    good = sampling.sample_rows(known.filter(F.col("y") == 1), id_col, positives)
    rows = sampling.texts_of(docs, good, id_col, text_col).select("y", "text").mapInArrow(
        tidy(_word_rows), "y int, buckets binary").toArrow()
    positive = [np.frombuffer(raw, np.int32).astype(np.int64) for raw in sorted(rows["buckets"].to_pylist())]
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.filter(~sampling.held_out(id_col, modulus, remainder)).select(
        F.xxhash64(text).alias("th"), text.alias("text"))
    in_unl, n_unl = _share_counts(texts) if positive else (None, 0)
    if not n_unl:
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(prior / (1 - prior))))
    once = _once(positive)
    used = significant(np.bincount(np.concatenate(once), minlength=1 << BUCKET_BITS), len(once), in_unl, n_unl)
    reduced = stored(_reduced(texts, used), "unlabelled")
    total = reduced.agg(F.sum("n")).first()[0]
    w = minimise(_compact(positive, used), _risk_over(reduced, total, len(used) + 1), len(used) + 1, prior)
    return _model(w, used)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id",
                   text_col: str = "text", modulus: int = 5, remainder: int = 0) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        weight, bias = shared.value
        for b in batches:
            data, off = flat(b.column("text"))
            z = np.full(len(off) - 1, bias)
            for i, j in blocks(off):
                f, doc = distinct_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                z[i:j] += np.bincount(doc, weights=weight[f], minlength=j - i)
            s = 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array(s),
                 pa.array((s >= threshold).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"),
                       sampling.held_out(id_col, modulus, remainder).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
