import hashlib
import random
import re

import pytest

from stratum.llm.winnow import contamination, decontaminate
from tests.llm.conftest import numbered


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    grams = {}
    for i, t in items:
        w = words(t)
        if not w:
            continue
        size = min(len(w), window)
        for p in range(len(w) - size + 1):
            grams.setdefault(tuple(w[p:p + size]), set()).add(i)
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                g = tuple(w[p:p + size])
                if g in grams:
                    hit |= set(range(p, p + size))
                    found |= grams[g]
        found.discard(None)  # items without an id hit, but have no name
        names = ",".join(sorted(str(x) for x in found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def setting(seed, short):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "x1", "Same"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.randrange(13, 40))) for i in range(25)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "..."), (None, items[5][1] + " tail"),
              (104, "same " * 30), (20, items[2][1])]
    if short:
        items += [(200, "w1 w2 w3"), (201, "solo"), (202, make(12)), (203, "É")]
    docs = [None, "", "...", "same " * 60, "solo", "W1-w2, w3!", make(3000)]
    for _ in range(60):
        t = make(rng.randrange(0, 60))
        for _ in range(rng.randrange(0, 4)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            piece = w[a:a + rng.randrange(8, 30)]
            at = rng.randrange(len(t) + 1)
            t = t[:at] + " " + rng.choice([" ", ", ", "\n"]).join(piece).upper() + " " + t[at:]
        docs.append(t)
    return numbered(docs) + [(8, docs[8]), (9, "another text under id nine"), (None, docs[10])], items


@pytest.mark.parametrize("seed,short", [(1, False), (2, True)])
def test_equals_brute_force(frame, lspark, seed, short):
    docs, items = setting(seed, short)
    bench = lspark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_hit int")
    got = contamination(frame(docs), bench).collect()
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str)
    assert rows == brute(docs, items)
    src = frame(docs)
    clean = decontaminate(src, bench)
    assert clean.columns == src.columns
    bad = {(d, t) for (d, t) in docs for r in brute([(d, t)], items) if r[5]}
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(
        ((d, t) for d, t in docs if (d, t) not in bad), key=str)


def test_every_alignment_of_one_window_is_found(frame, lspark):
    item = " ".join(f"i{k}" for k in range(40))
    docs = []
    for a in range(28):
        w = item.split()[a:a + 13]
        docs += [f"pre{a} " * (a % 5) + " ".join(w) + " post" * (a % 3), " ".join(w[:12])]
    docs = numbered(docs)
    bench = lspark.createDataFrame([(1, item)], "item_id long, text string")
    got = contamination(frame(docs), bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got),
                  key=str) == brute(docs, [(1, item)])


def test_empty_tables(frame, lspark):
    bench = lspark.createDataFrame([], "item_id long, text string")
    one = contamination(frame([(1, "a b c")]), bench).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in one] == [(3, 0, False)]
    assert contamination(frame([]), bench).count() == 0
