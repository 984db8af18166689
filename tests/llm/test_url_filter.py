import random
import re

import numpy as np

from stratum.llm.url_filter import Glob, LONG_URL, ShiftAnd, domain_rule, judge_urls, standard_globs


def matches(glob, text):
    """Dynamic programming over glob tokens: which token positions are reachable."""
    raw, tokens = glob.encode(), []
    while raw:
        size = 2 if raw.startswith(b"**") else 1
        tokens.append(raw[:size])
        raw = raw[size:]

    def closed(state):
        out = set(state)
        for i in sorted(state):
            while i < len(tokens) and tokens[i] in (b"*", b"**"):
                i += 1
                out.add(i)
        return out

    state = closed({0})
    for c in text:
        c, new = bytes([c]), set()
        for i in state:
            if i == len(tokens):
                continue
            t = tokens[i]
            if t == b"**" or (t == b"*" and c != b"/"):
                new.add(i)
            elif t == c or (t == b"?" and c != b"/"):
                new.add(i + 1)
        state = closed(new)
    return len(tokens) in state


def test_automaton_equals_regular_expressions():
    rng = random.Random(2)
    for _ in range(25):
        globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "?", "é"]) for _ in range(rng.randrange(0, 12)))
                 for _ in range(rng.randrange(1, 30))]
        texts = ["".join(rng.choice("aab/.é") for _ in range(rng.randrange(0, 20))).encode() for _ in range(40)]
        texts += [b"a" * (LONG_URL + 3) + b"/b", b""]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = ShiftAnd(globs).match(np.frombuffer(b"".join(texts), np.uint8), off)
        for g, glob in enumerate(globs):
            assert got[:, g].tolist() == [matches(glob, t) for t in texts], glob


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]


def test_rules_equal_brute_force(lspark):
    rng = random.Random(3)
    hosts = ["example.com", "www.example.com", "a.www.Example.COM", "notexample.com", "x.net", "net",
             "xnet", "casino-win.example.net", "a.org", "ads-track.example.org", "com", "b.com:80", ""]
    paths = ["", "/", "/en/", "/en", "/en/x", "/es/1", "/fr/2?x=/es/", "/x.net/es/", "?q=/en/", "#/en/", "/EN/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://", "a://b://", "") for h in hosts for p in paths]
    urls += [None, "", "://", "http://", "http://x.com/" + "a" * 5000, "http://é.com/\n/x"]
    rng.shuffle(urls)
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x")]
    df = lspark.createDataFrame(rows, "page_id long, url string, host string")
    got = judge_urls(df, standard_globs()).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = host_path(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        fits = [(rule, v) for rule, v in RULES
                if ("." + host).endswith("." + rule.split("/", 1)[0]) and path.startswith("/" + rule.split("/", 1)[1])]
        if fits:
            assert (r.rule, r.verdict) == max(fits, key=lambda x: len(x[0]))
        else:
            assert r.rule is None
            bad = re.search(r"\.(adult|casino|cheap|spam|ads)-|\.ad[^/]\.", "." + host)
            assert r.verdict == ("block" if bad else "allow")


def test_rules_of_many_words_and_empty_table(lspark):
    globs = [domain_rule("block", f"h{i}.com", "/") for i in range(200)] + [Glob("**", "allow")]
    df = lspark.createDataFrame([(i, f"http://s.h{i}.com/") for i in range(0, 220, 7)], "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(df, globs).collect()}
    assert all((r.rule == f"h{i}.com/") == (i < 200) for i, r in got.items())
    assert judge_urls(df.limit(0), globs).count() == 0
