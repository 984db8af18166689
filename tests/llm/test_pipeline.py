import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from stratum.llm import bpe, quality
from stratum.sources.tables import read_table
from tests.llm import test_minhash, test_pii, test_winnow

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def kept(lspark, tmp_path_factory):
    """Input and output rows of every stage."""
    docs = read_table(lspark, SF, "documents")
    steps = []
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(lspark, docs, SF).write.parquet(path)
        out = lspark.read.parquet(path)
        steps.append((name, docs, out))
        docs = out
    return {name: (a.collect(), b.collect(), a.columns, b.columns) for name, a, b in steps}


def test_columns_and_order(kept):
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "tokens"]
    for name, (_, _, a, b) in kept.items():
        if name != "tokens":
            assert a == b == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_what_the_classifier_accepts(lspark, kept):
    docs = read_table(lspark, SF, "documents")
    model = quality.fit_quality(docs, read_table(lspark, SF, "labels", ["doc_id", "quality"]))
    good = {r.doc_id for r in quality.score_quality(docs, model).collect() if r.predicted}
    before, after, *_ = kept["quality"]
    assert {r.doc_id for r in after} == good and 0 < len(good) < len(before)


def test_near_dedup_keeps_one_of_each_class(kept):
    before, after, *_ = kept["near_dedup"]
    want = [i for i, _, c in test_minhash.brute([(r.doc_id, r.text) for r in before], 80) if i == c]
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_decontamination_drops_contaminated_documents(lspark, kept):
    before, after, *_ = kept["decontaminate"]
    items = [(r.item_id, r.text) for r in read_table(lspark, SF, "benchmark").collect()]
    judged = test_winnow.brute([(r.doc_id, r.text) for r in before], items)
    assert sorted(r.doc_id for r in after) == sorted(d for d, *_, bad in judged if not bad)


def test_pii_is_replaced_and_clean_texts_stay(kept):
    before, after, *_ = kept["pii"]
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == set(texts)
    touched = 0
    for r in after:
        spans = test_pii.brute(texts[r.doc_id])[1]
        assert not test_pii.brute(r.text)[1] and r.n_chars == len(r.text)
        if r.text == texts[r.doc_id]:
            assert not spans
        touched += bool(spans)
    assert touched


def test_tokens_equal_the_library(kept):
    import tiktoken

    before, after, *_ = kept["tokens"]
    path, pattern = bpe.standard_ranks()
    with open(path, "rb") as f:
        ranks = bpe.Encoder(f.read(), pattern).ranks
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        ids = np.array(own.encode_ordinary(texts[r.doc_id]), dtype="<u4").tobytes()
        assert bytes(r.token_ids) == ids and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_gives_the_rows_of_the_last_stage(lspark, kept):
    out = C.run(lspark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in out) == sorted(
        (r.doc_id, r.ids_sha256) for r in kept["tokens"][1])


HELPERS = ["_s", "_w", "_b", "_may", "_twice", "_one", "_id", "_th", "row", "key", "odd", "number", "id", "th", "n",
           "text_hash", "_drop_key", "_drop_id", "own", "own_th", "kept", "component", "Weird.name", "a`b"]


def test_stages_carry_columns_of_any_name(lspark):
    """Columns whose names the stages use themselves come back unchanged."""
    base = read_table(lspark, SF, "documents").limit(60)
    docs = base.select("*", *[F.concat(F.lit(f"{h}-"), F.col("doc_id")).alias(h) for h in HELPERS])
    docs = lspark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in C.STAGES[:-1]:
        out = stage(lspark, docs, SF)
        assert out.columns == docs.columns, name
        before = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        assert rows and all(r[h] == before[r.doc_id][h] for r in rows for h in HELPERS), name
    assert C.STAGES[-1][1](lspark, docs, SF).count() == 60


def test_repeated_and_missing_ids(lspark):
    """Rows of one id are told apart by their texts; equal (id, text) rows are one document."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    rows = [(1, words(1)), (1, words(2)), (1, words(2)), (None, words(3)), (None, words(3)), (None, words(4)),
            (2, words(5)), (3, words(5) + " end"), (4, words(4)), (5, None), (5, ""), (None, None)]
    docs = lspark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(C.STAGES)
    out = sorted(((r.doc_id, r.text) for r in stages["near_dedup"](lspark, docs, SF).collect()), key=str)
    # the two empty texts of id 5 have one text hash: one document; so have equal rows
    want = [(1, words(1)), (1, words(2)), (2, words(5)), (4, words(4)), (None, words(3)), (None, None)]
    assert [o for o in out if o[0] != 5] == sorted(want, key=str) and sum(o[0] == 5 for o in out) == 1
    clean = stages["decontaminate"](lspark, docs, SF)
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))


@pytest.mark.parametrize("name", ["near_dedup", "decontaminate", "pii", "tokens"])
def test_stages_of_empty_tables(lspark, name):
    docs = read_table(lspark, SF, "documents").limit(0)
    assert dict(C.STAGES)[name](lspark, lspark.createDataFrame([], docs.schema), SF).count() == 0
