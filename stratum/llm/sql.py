"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Host and path as the contract defines them, then the longest fitting rule; URLs
# without a rule are judged by the method's globs, written as regular expressions.
OP3 = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(host_end, path_start, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT p.*, r.host_end || r.path_start AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                       ORDER BY length(r.host_end || r.path_start) DESC) AS n
  FROM parts p JOIN rules r
    ON ends_with('.' || p.host, '.' || r.host_end) AND starts_with(p.path, r.path_start))
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, CASE WHEN regexp_matches('.' || p.host,
      '(?s)\.(adult|casino|cheap|spam|ads)-[^/]*$|\.ad[^/]\.[^/]*$') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN (SELECT DISTINCT page_id, host, path, rule, verdict FROM fits WHERE n = 1) f
  ON f.page_id IS NOT DISTINCT FROM p.page_id AND f.host = p.host AND f.path = p.path
"""

OP4 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.w, d.w), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

# Words and 13-word windows spelled out; every document window is looked up.
OP8 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes)),
met AS (SELECT s.doc_id, s.size, s.i, x.item_id FROM spots s JOIN windows x USING (size, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM met))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("\\\\", "\\")

# Exact similarity over an inverted index of shingles, then the closure of the links.
OP7 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
  least(coalesce(c.least, w.doc_id), w.doc_id) AS component_id,
  least(coalesce(c.least, w.doc_id), w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN comp c USING (doc_id)
"""

# Personal data: matches and the gaps between them give the positions; each kind has a
# check, the added kinds also look at the neighbours of the match and at context words.
_LUHN = """(list_sum(list_transform(range(1, length(d) + 1), lambda i:
    CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::INT
         WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9 ELSE 2 * d[i]::INT END)) % 10 = 0)"""
_PII_KINDS = [  # kind, pattern, condition on t (match), d (its digits), c (before), f (after)
    ("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "true"),
    ("ip", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
     "len(list_filter(string_split(t, '.'), lambda p: length(ltrim(p, '0')) > 3 "
     "OR coalesce(try_cast(left(ltrim(p, '0'), 3) AS INT), 0) > 255)) = 0"),
    ("card", "[0-9]([ -]?[0-9])+", f"CASE WHEN length(d) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END"),
    ("phone", "\\+[0-9][ ().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15"),
    ("short_card", "[0-9]([ -]?[0-9])+",
     f"CASE WHEN length(d) BETWEEN 13 AND 15 THEN {_LUHN} ELSE false END "
     "AND regexp_matches(lower(c), 'card|visa|amex|credit|karte|carte|tarjeta')"),
    ("national_id", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
     "NOT regexp_matches(t, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(b, '[0-9-]') "
     "AND NOT regexp_matches(f, '[0-9-]') AND regexp_matches(lower(c), 'ssn|social security')"),
    ("local_phone", "\\(?[0-9]{3}\\)?[ .-][0-9]{3}[ .-][0-9]{4}",
     "NOT regexp_matches(b, '[0-9+().-]') AND NOT regexp_matches(f, '[0-9]') "
     "AND regexp_matches(lower(c), 'tel|phone|call|mobile|fax')"),
]


def _iban_sql() -> str:
    """IBAN matches (r, s, t): words that begin like one; a match ends at its country's length
    or, for other lengths and codes, with the last word that fits, and never runs over a blank
    into a complete IBAN.  The automaton of DuckDB has no lookaround, so the text is cut there."""
    from stratum.llm.pii import _IBAN_LENGTHS

    exact = "(?:" + "|".join(
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
        + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, codes in _IBAN_LENGTHS.items()) + ")"
    other = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    end = "(?:[^A-Za-z0-9]|$)"
    return f"""
iban_word AS (
  SELECT r, x, w, (sum(length(w)) OVER (PARTITION BY r ORDER BY i) - length(w))::BIGINT AS s FROM (
    SELECT r, x, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
      SELECT r, x, regexp_extract_all(x, '[A-Za-z0-9]+|[^A-Za-z0-9]+') AS ws FROM docs
      WHERE regexp_matches(x, '[A-Z]{{2}}[0-9]{{2}} ?[A-Z0-9]{{4}}')))),
iban_start AS (
  SELECT r, x, s, s > 0 AND substring(x, greatest(s, 1), 1) = ' '
    AND regexp_matches(substring(x, s + 1, 60), '^{exact}{end}') AS whole
  FROM iban_word WHERE regexp_matches(w, '^[A-Z]{{2}}[0-9]{{2}}')),
iban_room AS (
  SELECT r, s, CASE WHEN n IS NULL THEN substring(x, s + 1, 60)
                    ELSE substring(x, s + 1, least(60, n - 1 - s)) END AS y
  FROM (SELECT *, min(CASE WHEN whole THEN s END) OVER (
          PARTITION BY r ORDER BY s ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM iban_start)),
iban_hit AS (
  SELECT * FROM (SELECT r, s, coalesce(nullif(regexp_extract(y, '^({exact}){end}', 1), ''),
                                       nullif(regexp_extract(y, '^({other}){end}', 1), '')) AS t FROM iban_room)
  WHERE t IS NOT NULL),
iban(r, s, t) AS (
  SELECT r, s, t FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s) AS n FROM iban_hit) WHERE n = 1
  UNION ALL
  SELECT h.r, h.s, h.t FROM iban i JOIN iban_hit h ON h.r = i.r AND h.s >= i.s + length(i.t)
  WHERE NOT EXISTS (SELECT 1 FROM iban_hit k WHERE k.r = h.r AND k.s >= i.s + length(i.t) AND k.s < h.s))"""


_MOD97_SQL = """length(replace(t, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_concat([0], list_transform(
        string_split(substring(replace(t, ' ', ''), 5) || left(replace(t, ' ', ''), 4), ''), lambda z:
        CASE WHEN z BETWEEN '0' AND '9' THEN ascii(z) - 48 ELSE ascii(z) - 55 END)),
        lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1"""


def _pii() -> str:
    numbers = {name: n for n, name in enumerate(
        ("email", "ip", "card", "phone", "iban", "short_card", "national_id", "local_phone"))}
    kinds = " UNION ALL ".join(
        f"SELECT r, x, {numbers[name]} AS k, '{name}' AS kind, h, g FROM (SELECT r, x, "
        f"regexp_extract_all(x, '{rx}') AS h, string_split_regex(x, '{rx}') AS g FROM docs)"
        for name, rx, _ in _PII_KINDS)
    checks = " ".join(f"WHEN {numbers[name]} THEN {check}" for name, _, check in _PII_KINDS)
    return f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
found AS ({kinds}),
each AS (
  SELECT r, x, k, kind, i, h[i] AS t, regexp_replace(h[i], '[^0-9]', '', 'g') AS d,
    right(g[i], 1) AS b, left(g[i + 1], 1) AS f, length(g[i]) AS gl, length(h[i]) AS hl
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM found WHERE len(h) > 0)),
placed AS (
  SELECT *, sum(gl + hl) OVER (PARTITION BY r, k ORDER BY i) AS e FROM each),
near AS (  -- the 40 characters of the text before the match
  SELECT *, substring(x, greatest(e - hl - 40, 0)::BIGINT + 1, least(e - hl, 40)::BIGINT) AS c FROM placed),{_iban_sql()},
spans AS (
  SELECT r, k, kind, e - hl AS s, e FROM near WHERE CASE k {checks} END
  UNION ALL
  SELECT r, 4, 'iban', s, s + length(t) FROM iban WHERE {_MOD97_SQL}),
kept AS (
  SELECT * FROM spans a WHERE k < 4 OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.r = a.r AND b.k < 4 AND b.s < a.e AND a.s < b.e)),
listed AS (
  SELECT r, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip,
    count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans,
    count(*) FILTER (k >= 4) AS n_added
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
  coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_added, 0)::BIGINT AS n_added
FROM docs LEFT JOIN listed USING (r)
"""


def _crc32(x: str) -> str:
    """crc32 of the UTF-8 bytes of a string, byte by byte with the table of its polynomial."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return (f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform("
            f"regexp_extract_all(hex(encode({x})), '..'), lambda b: ('0x' || b)::BIGINT)), "
            f"lambda a, b: xor(a >> 8, list_extract({table}, (xor(a, b) & 255) + 1))))")


def _hilbert(bits: int = 4, buckets: int = 16, salts: int = 64, shards: int = 16) -> str:
    from stratum.llm.hilbert import curve_tables

    digit, follow = curve_tables(3)
    steps, last = "", "point"
    for b in reversed(range(bits)):
        octant = f"(((x0 >> {b}) & 1) * 4 + ((x1 >> {b}) & 1) * 2 + ((x2 >> {b}) & 1))"
        steps += f""",
step{b} AS (SELECT * EXCLUDE (s, h), {follow}[s * 8 + {octant} + 1] AS s,
  h * 8 + {digit}[s * 8 + {octant} + 1] AS h FROM {last})"""
        last = f"step{b}"
    return f"""
WITH meta AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS crc,
    {_crc32("coalesce(lang, '')")} % {1 << bits} AS x0, {_crc32("coalesce(source, '')")} % {1 << bits} AS x1,
    {_crc32("coalesce(doc_id::VARCHAR, '')")} % {salts} AS salt
  FROM documents),
point AS (
  SELECT *, least(length(bin(size)) - 1, {(1 << bits) - 1}) AS x2, 0 AS s, 0::BIGINT AS h FROM meta){steps},
placed AS (
  SELECT *, row_number() OVER (ORDER BY h, crc % {buckets} * {salts} + salt, crc, doc_id NULLS FIRST, size) - 1 AS p,
    count(*) OVER () AS n FROM {last}),
cut AS (SELECT *, p * {shards} // n AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (p - (shard * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard, h::BIGINT AS curve
FROM cut
"""


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every round spelled out: the nearest entry of each part, then the floored means."""
    steps = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
shape AS (SELECT (coalesce(max(len(x)), 0) + {parts - 1}) // {parts} AS dims FROM kept),
parts AS (
  SELECT r, vec_id, x, p, list_transform(range(1, dims + 1),
    lambda i: floor({scale} * coalesce(x[p * dims + i], 0))::BIGINT) AS v
  FROM kept, shape, range({parts}) t(p)),
c0 AS (
  SELECT p, e - 1 AS e, v FROM (
    SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, x) AS e FROM parts)
  WHERE e <= {entries})"""
    for k in range(rounds + 1):
        steps += f""",
a{k} AS MATERIALIZED (
  SELECT r, p, v, m % {entries} AS e, m // {entries} AS d FROM (
    SELECT r, p, any_value(x.v) AS v, min({entries} * coalesce(list_sum(list_transform(
      list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::BIGINT + c.e) AS m
    FROM parts x JOIN c{k} c USING (p) GROUP BY r, p))"""
        if k < rounds:
            steps += f""",
m{k} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
    SELECT p, e, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n
    FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS i FROM a{k}) GROUP BY p, e, i)
  GROUP BY p, e),
c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.e = c.e)"""
    return steps + f""",
books AS (
  SELECT sha256(coalesce(string_agg(array_to_string(v, ','), ',' ORDER BY p, e), '')) AS sha FROM c{rounds}),
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  sha AS codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


def _resample(percent: int = 5, least_words: int = 20, buckets: int = 10000, seed: int = 42) -> str:
    """Runs of one to three words spelled out; each distinct run is hashed once."""
    words = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    runs = """list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))"""
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
items AS (SELECT {words} AS w FROM benchmark),
f AS MATERIALIZED (SELECT r, unnest({runs}) AS f FROM docs),
g AS MATERIALIZED (SELECT unnest({runs}) AS f FROM items),
crcs AS MATERIALIZED (
  SELECT f, {_crc32("f")} % {buckets} AS b FROM (SELECT f FROM f UNION SELECT f FROM g)),
s AS (SELECT b, count(*) AS s FROM f JOIN crcs USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM g JOIN crcs USING (f) GROUP BY b),
gains AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + {buckets})
      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM g) + {buckets}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (b)),
weights AS (
  SELECT r, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS weight
  FROM f JOIN crcs USING (f) JOIN gains USING (b) GROUP BY r),
scores AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n
  FROM scores WHERE n_words >= {least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * n // 100 THEN rank END AS rank
FROM scores LEFT JOIN placed USING (r)
"""


SQL = {"op1_pii": _pii(),
       "op4_exact_topk": OP4,
       "op7_bbit_minhash": OP7,
       "op5_hilbert_shards": _hilbert(),
       "op8_winnowing": OP8,
       "op3_url_filter": OP3,
       "op11_lloyd_codes": _lloyd(),
       "op13_importance_resampling": _resample()}
