import random
import zlib

import numpy as np
import pytest

from stratum.llm import quality, toxicity
from tests.llm.conftest import by_id

INSULTS = ["scum", "moron", "idiot", "trash"]


def data(n, seed):
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("ba", "to", "ri", "ne", "lu", "ka") for b in ("mo", "si", "te", "ru", "pa")]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        good, toxic = int(rng.random() < 0.7), int(rng.random() < 0.2)
        if not good:
            w = rng.choice([[x.upper() + "!!" for x in w], [x + "|" for x in w], [w[0]] * len(w)])
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, good, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(lspark):
    docs, labels = data(1500, 1)
    extra = [(9001, None), (9002, ""), (9003, "x" * 300000), (9004, "scum " * 50), (None, "ba mo"), (3, docs[3][1])]
    d = lspark.createDataFrame([(i, t, "en", 0.0, "x") for i, t in docs + extra],
                               "doc_id long, text string, lang string, score double, y string")
    lab = lspark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (1, 0, 0)],
                                 "doc_id long, quality int, toxic int")
    return d, lab, dict((i, (q, t)) for i, q, t in labels)


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_held_out_accuracy(tables, name):
    docs, labels, known = tables
    if name == "quality":
        out = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
        modulus, remainder, column, threshold = 4, 2, 0, 0.7
    else:
        out = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()
        modulus, remainder, column, threshold = 5, 0, 1, 0.5
    assert len(out) == docs.count()
    for r in out:
        want = True if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % modulus == remainder
        assert r.held_out == want
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    test = [r for r in out if r.held_out and r.doc_id in known]
    y = np.array([known[r.doc_id][column] for r in test])
    assert (np.array([r.predicted for r in test]) == y).mean() > 0.95
    assert auc(np.array([r.score for r in test]), y) > 0.97
    empty = {r.score for r in out if r.doc_id in (9001, 9002)}
    assert len(empty) == 1


def test_text_alone_decides(tables, lspark):
    docs, labels, _ = tables
    model = quality.fit_quality(docs, labels)
    again = quality.fit_quality(docs.repartition(7), labels)
    assert np.allclose(model.bucket, again.bucket) and model.bias == pytest.approx(again.bias)
    rows = [(1, "ba mo ri", "en"), (2, "ba mo ri", None), (3, "ba mo ri", "xx")]
    df = lspark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len({r.score for r in quality.score_quality(df, model).collect()}) == 1


def test_no_labels_and_empty_tables(tables, lspark):
    docs, labels, _ = tables
    none = labels.limit(0)
    q = by_id(quality.score_quality(docs, quality.fit_quality(docs, none)))
    t = by_id(toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)))
    assert len({r.score for r in q.values()}) == 1 and len({r.score for r in t.values()}) == 1
    empty = docs.limit(0)
    assert quality.score_quality(empty, quality.fit_quality(empty, labels)).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, labels)).count() == 0


def test_kept_rows_are_those_predicted_good(tables):
    docs, labels, _ = tables
    model = quality.fit_quality(docs, labels)
    good = sorted(str(r.doc_id) for r in quality.score_quality(docs, model).collect() if r.predicted)
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == good


def test_positive_unlabelled_risk_beats_treating_unlabelled_as_clean():
    """Half of the positives hide among the unlabelled rows; the prior corrects for them."""
    rng = np.random.RandomState(3)
    make = lambda toxic: np.unique(np.concatenate(
        [rng.randint(100, 3000, 60), rng.choice(10, 2) if toxic else []]).astype(np.int64))
    positive = [make(True) for _ in range(300)]
    hidden = [make(True) for _ in range(600)]
    clean = [make(False) for _ in range(1400)]
    m = toxicity.train(positive, hidden + clean, prior=0.3)
    score = lambda rows: np.array([m.weight[r].sum() + m.bias for r in rows])
    assert (score(hidden) > 0).mean() > 0.85 and (score(clean) < 0).mean() > 0.95


# ------------------------------------------------- one document's score, in plain Python
MASK = (1 << 64) - 1


def _mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def _hash(word):
    from stratum.llm.textops import BYTE_CODES

    base = 0x9E3779B97F4A7C15 | 1
    return _mix(sum(int(BYTE_CODES[b]) * pow(base, i, 1 << 64) for i, b in enumerate(word)) & MASK)


def _logistic(z):
    import math

    return 1 / (1 + math.exp(-z))


TEXTS = ["ba mo ri scum", "Ba BA ba scum, ba|mo trash\tTO ri ba ba ba", "", None, "é ba!! 😀 a " + "ru pa " * 40]


def test_toxicity_score_of_a_document_by_hand(tables, lspark):
    import re

    docs, labels, _ = tables
    model = toxicity.fit_toxicity(docs, labels)
    rows = lspark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = by_id(toxicity.score_toxicity(rows, model))
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
        buckets = {_hash(w) >> (64 - toxicity.BUCKET_BITS) for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower)}
        assert got[i].score == pytest.approx(_logistic(sum(model.weight[b] for b in buckets) + model.bias), rel=1e-9)


def test_quality_score_of_a_document_by_hand(tables, lspark):
    import re

    docs, labels, _ = tables
    model = quality.fit_quality(docs, labels)
    rows = lspark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = by_id(quality.score_quality(rows, model))
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
        found = [_hash(w) >> (64 - quality.BUCKET_BITS) for w in words]
        for n, w in enumerate(words):
            back = [d for d in range(1, quality.BACK + 1) if d <= n and words[n - d] == w]
            found.append((back[0] if back else 0) + quality.REPEAT_BUCKET)
        for k in quality.GRAMS:
            for p in range(len(raw) - k + 1):
                if all(b not in b" \t\n\r\x0b\x0c" for b in raw[p + 1:p + k - 1]):
                    key = int.from_bytes(raw[p:p + k], "little") + k & 0xFFFFFFFF
                    key = key * 0x9E3779B1 & 0xFFFFFFFF
                    key ^= key >> 15
                    found.append((key * 0x85EBCA77 & 0xFFFFFFFF) >> (32 - quality.BUCKET_BITS))
        mean = sum(model.bucket[f] for f in found) / max(1, len(found))
        assert got[i].score == pytest.approx(_logistic(mean + model.bias), rel=1e-9)


def test_every_unlabelled_row_counts(tables, lspark):
    """A word that positives share with unlabelled rows alone loses its weight, however many
    rows there are: nothing is sampled on the unlabelled side."""
    docs, labels, _ = tables
    few = toxicity.fit_toxicity(docs, labels)
    more = lspark.range(20000, 32000).selectExpr(
        "id AS doc_id", "concat('trash ', id, ' ba mo') AS text", "'en' AS lang", "0D AS score", "'x' AS y")
    many = toxicity.fit_toxicity(docs.unionByName(more), labels)
    trash = _hash(b"trash") >> (64 - toxicity.BUCKET_BITS)
    assert few.weight[trash] > 2 and many.weight[trash] < 0.25 * few.weight[trash]
