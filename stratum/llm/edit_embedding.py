"""Document fingerprints: randomised edit embedding, bit-sampled banding, verification.

Embedding.  A walker reads a text character by character.  At step t it stands on one
character c, which is the embedding's symbol at t, and a random function shared by all
texts decides from (t, c) whether it moves on to the next character or repeats this
one.  Two texts with the same beginning share the walk; after an edit the walkers drift
apart and meet again by chance, from where on they agree once more.  So a small edit
distance becomes a small Hamming distance of the embeddings, and texts that differ in
a part agree in the other part.  Two walks with independent functions steady the result.

Fingerprint.  One bit of a hash of (t, c) is kept at sampled steps t, the same for all
texts: all steps below 256, then SHELL_BITS steps of every shell [2**s, 2**(s+1)).  It
grows with the logarithm of the text only, and texts of any two lengths are compared on
shared steps.  As a string: characters, then steps and bits (hex) of each walk.

Likeness.  Bits of unlike characters agree half of the time, so agreement counts +1 and
disagreement -1; a step that only one text reaches counts 0.  Shells are weighted by
their length; the mean over the walks, no less than 0, estimates the share of the
embedding that agrees.

Banding and verification (``edit_classes``).  A band is a set of bits drawn from one of the
two last full shells; texts that agree on a band are candidates.  The number of bits
grows with the number of texts, the number of bands follows from the wanted recall.
Candidates are verified on the whole fingerprint.  Within a band's group all members
are compared with the one of least id; members that are not like it form the next
round's group, until none is left.  So links between different texts are found without
emitting all pairs, and equal texts are one text from the start.

The next document.  Ids are range-partitioned alone; the least id of every range is a
border (one per partition, on the driver).  Texts are then dealt by these borders, and
the document of a border goes to the range before it as well: one shuffle of the texts,
read in order by streaming tasks that hold two documents at a time.

Defined results: a null text is empty; two empty texts are alike (1), an empty and a
non-empty one are not (0).  Repeated ids follow each other by the xxhash64 of their texts,
null ids come last.  A single document is its own next one.  Other columns are not
looked at.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import stored, tidy

WALKS = 2
PERIOD = 1024      # the move functions repeat after so many steps
CLASSES = 256      # and depend on a character through its class
SHELL_BITS = 128
CHUNK = 1 << 16    # characters of a very long text walked at once
LONG_TEXT = 1 << 18
RUN_CHARS = 1 << 21  # characters of the texts that are walked together
TOGETHER = 64      # fewer texts than this are walked one by one
_SEED = 20240911

_moves: dict[int, list] = {}
_flat: dict[int, np.ndarray] = {}
_steps: dict[int, np.ndarray] = {}


def _table(walk: int) -> list:
    """Rows by step modulo PERIOD: the row in which each class is left; last, the own step."""
    if walk not in _moves:
        move = np.random.RandomState(_SEED + walk).randint(0, 2, (PERIOD, CLASSES), dtype=np.int8)
        move[PERIOD - 1, move.sum(axis=0) == 0] = 1
        nxt = np.empty((PERIOD, CLASSES), dtype=np.int64)
        ahead = move.argmax(axis=0) + PERIOD  # first move after a turn of the period
        for t in range(PERIOD - 1, -1, -1):
            ahead = np.where(move[t] == 1, t, ahead)
            nxt[t] = (ahead + 1) % PERIOD
        rows: list = [[] for _ in range(PERIOD)]
        for t, row in enumerate(rows):
            row.extend([rows[n] for n in nxt[t].tolist()])
            row.append(t)
        _moves[walk] = rows
    return _moves[walk]


def sampled_steps(walk: int, upto: int) -> np.ndarray:
    """All sampled steps of the shells that hold a step below ``upto``, ascending."""
    have = _steps.get(walk)
    if have is None:
        have = np.arange(256, dtype=np.int64)
    shell = 8 + (len(have) - 256) // SHELL_BITS
    while (1 << shell) < upto:
        rng = np.random.RandomState([_SEED, walk, shell])
        more = np.sort((1 << shell) + (rng.random_sample(SHELL_BITS) * (1 << shell)).astype(np.int64))
        have = np.concatenate([have, more])
        shell += 1
    _steps[walk] = have
    return have


def _classes(chars: np.ndarray) -> bytes:
    return np.where(chars < 256, chars, (chars * np.uint32(2654435761)) >> np.uint32(24)).astype(
        np.uint8).tobytes()


class Walker:
    """One walk over the characters fed so far."""

    def __init__(self, walk: int):
        self.walk, self.state, self.steps, self.bits = walk, 0, 0, []

    def feed(self, chars: np.ndarray) -> None:
        from stratum.llm.textops import U, mix

        rows = _table(self.walk)
        for at in range(0, len(chars), CHUNK):
            part = chars[at:at + CHUNK]
            seen = np.fromiter(map(itemgetter(CLASSES), accumulate(
                _classes(part), getitem, initial=rows[self.state])), dtype=np.int64, count=len(part) + 1)
            left = seen[1:] - seen[0] + PERIOD * np.cumsum(seen[1:] <= seen[:-1])  # steps when left
            end = self.steps + int(left[-1])
            steps = sampled_steps(self.walk, end)
            lo, hi = np.searchsorted(steps, (self.steps, end))
            mine = steps[lo:hi]
            char = part[np.searchsorted(left, mine - self.steps, side="right")]
            self.bits.append((mix(mine.astype(U) * U(0x9E3779B97F4A7C15) + char.astype(U)
                                  + U(self.walk << 40)) & U(1)).astype(np.uint8))
            self.state, self.steps = int(seen[-1]), end

    def read(self) -> np.ndarray:
        return np.concatenate(self.bits) if self.bits else np.zeros(0, np.uint8)


def _next_states(walk: int) -> np.ndarray:
    if walk not in _flat:
        rows = _table(walk)
        _flat[walk] = np.array([[r[c][CLASSES] for c in range(CLASSES)] for r in rows], dtype=np.int16).ravel()
    return _flat[walk]


def _lockstep(classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, walk: int,
              states: np.ndarray) -> np.ndarray:
    """The state after every character, for many texts one character at a time together."""
    nxt = _next_states(walk)
    order = np.argsort(-sizes, kind="stable")
    at, state = starts[order], states[order].astype(np.int32)
    longest = int(sizes.max(initial=0))
    live = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # texts of more than p characters
    seen = np.empty(len(classes), dtype=np.int16)
    p = 0
    while p < longest and live[p] >= TOGETHER:
        spot = at[:live[p]] + p
        state = nxt[(state[:live[p]] << 8) | classes[spot]].astype(np.int32)
        seen[spot] = state
        p += 1
    if p < longest:  # the few longest ones, each by itself
        rows = _table(walk)
        for j in range(int(live[p])):
            lo, hi = int(at[j]) + p, int(at[j] + sizes[order[j]])
            one = accumulate(classes[lo:hi].tobytes(), getitem, initial=rows[int(state[j])])
            seen[lo:hi] = np.fromiter(map(itemgetter(CLASSES), one), dtype=np.int16, count=hi - lo + 1)[1:]
    return seen


class _Walked:
    """One walk over a run of texts, possibly continued from given states and steps."""

    def __init__(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray, walk: int,
                 states: np.ndarray | None = None, steps: np.ndarray | None = None):
        from stratum.llm.textops import U, mix

        n = len(sizes)
        self.starts, self.sizes = starts, sizes
        self.first_state = np.zeros(n, np.int64) if states is None else states
        self.first_step = np.zeros(n, np.int64) if steps is None else steps
        self.seen = _lockstep(np.frombuffer(_classes(chars), np.uint8), starts, sizes, walk, self.first_state)
        before = np.empty(len(chars), dtype=np.int64)
        before[1:] = self.seen[:-1]
        full = sizes > 0
        before[starts[full]] = self.first_state[full]
        # Steps spent on each character: 1 to PERIOD; the clock runs on over all texts.
        self.clock = np.concatenate([[0], np.cumsum(((self.seen - before - 1) & (PERIOD - 1)) + 1)])
        self.end = self.first_step + self.clock[starts + sizes] - self.clock[starts]
        table = sampled_steps(walk, int(self.end.max(initial=0)))
        lo, hi = np.searchsorted(table, self.first_step), np.searchsorted(table, self.end)
        count = hi - lo
        self.cut = np.concatenate([[0], np.cumsum(count)])
        text = np.repeat(np.arange(n), count)
        t = table[np.arange(len(text)) - self.cut[text] + lo[text]]
        spot = np.searchsorted(self.clock[1:], t - self.first_step[text] + self.clock[starts[text]], side="right")
        self.bits = (mix(t.astype(U) * U(0x9E3779B97F4A7C15) + chars[spot].astype(U) + U(walk << 40))
                     & U(1)).astype(np.uint8)
        self.table = table

    def of(self, i: int) -> np.ndarray:
        return self.bits[self.cut[i]:self.cut[i + 1]]

    def at(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, step) of every text after its first ``inside`` characters."""
        state = self.first_state.copy()
        some = inside > 0
        state[some] = self.seen[(self.starts + inside - 1)[some]]
        return state, self.first_step + self.clock[self.starts + inside] - self.clock[self.starts]


def prints_of(texts: list[np.ndarray]) -> list["Print"]:
    """Fingerprints of texts (character codes), walked together; very long ones by themselves."""
    return _prints_and_walks(texts)[0]


def _prints_and_walks(texts: list[np.ndarray]):
    short = [i for i, t in enumerate(texts) if len(t) <= LONG_TEXT]
    out: list = [None] * len(texts)
    for i, t in enumerate(texts):
        if len(t) > LONG_TEXT:
            walkers = [Walker(w) for w in range(WALKS)]
            for w in walkers:
                w.feed(t)
            out[i] = _finish(len(t), walkers)
    sizes = np.array([len(texts[i]) for i in short], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    chars = np.concatenate([texts[i] for i in short]) if short else np.zeros(0, np.uint32)
    walks = [_Walked(chars, starts, sizes, w) for w in range(WALKS)]
    for k, i in enumerate(short):
        out[i] = Print(len(texts[i]), [(int(w.end[k]), w.of(k)) for w in walks])
    return out, {i: k for k, i in enumerate(short)}, walks


def edited_prints(texts: list[np.ndarray]) -> list[tuple["Print", "Print"]]:
    """(fingerprint, fingerprint of the edited text) of every text but the last; the edited
    text goes on, in its second half, with the beginning of the text after it.

    The walk over the first half is not repeated: the edited text's goes on from there.
    """
    prints, place, walks = _prints_and_walks(texts)
    half = [len(t) // 2 for t in texts]
    new = [texts[i + 1][:half[i]] for i in range(len(texts) - 1)]
    out: list = [None] * len(new)
    short = [i for i in range(len(new)) if i in place and len(new[i]) <= LONG_TEXT]
    for i in set(range(len(new))) - set(short):
        walkers = [Walker(w) for w in range(WALKS)]
        for w in walkers:
            w.feed(texts[i][:len(texts[i]) - half[i]])
            w.feed(new[i])
        out[i] = (prints[i], _finish(len(texts[i]) - half[i] + len(new[i]), walkers))
    middle = np.zeros(len(place), dtype=np.int64)
    for i, k in place.items():
        middle[k] = len(texts[i]) - half[i]
    sizes = np.array([len(new[i]) for i in short], dtype=np.int64)
    chars = np.concatenate([new[i] for i in short]) if short else np.zeros(0, np.uint32)
    rows = np.array([place[i] for i in short], dtype=np.int64)
    found: list[list] = [[] for _ in short]
    for w, walk in enumerate(walks):
        state, step = walk.at(middle)
        more = _Walked(chars, np.cumsum(sizes) - sizes, sizes, w, state[rows], step[rows])
        kept = np.searchsorted(walk.table, step[rows])  # sampled steps of the first half
        for k in range(len(short)):
            own = walk.of(int(rows[k]))[:kept[k]]
            found[k].append((int(more.end[k]), np.concatenate([own, more.of(k)])))
    for k, i in enumerate(short):
        out[i] = (prints[i], Print(len(texts[i]) - half[i] + len(new[i]), found[k]))
    return out


class Print:
    """Fingerprint: characters, and (steps, bits) of every walk."""

    def __init__(self, chars: int, walks: list[tuple[int, np.ndarray]]):
        self.chars, self.walks = chars, walks

    def __str__(self) -> str:
        return ":".join([str(self.chars)] + [f"{s}:{np.packbits(b).tobytes().hex()}" for s, b in self.walks])

    @staticmethod
    def parse(text: str) -> "Print":
        chars, *rest = text.split(":")
        walks = []
        for w, (steps, raw) in enumerate(zip(rest[0::2], rest[1::2])):
            n = int(np.searchsorted(sampled_steps(w, int(steps)), int(steps)))
            walks.append((int(steps), np.unpackbits(np.frombuffer(bytes.fromhex(raw), np.uint8), count=n)))
        return Print(int(chars), walks)


def _finish(chars: int, walkers: list[Walker]) -> Print:
    return Print(chars, [(w.steps, w.read()) for w in walkers])


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def fingerprint(text: str | None) -> Print:
    chars = codes(text or "")
    walkers = [Walker(w) for w in range(WALKS)]
    for w in walkers:
        w.feed(chars)
    return _finish(len(chars), walkers)


def likeness(a: Print, b: Print) -> float:
    """Estimated share of the embeddings that agrees, 0 to 1; 1 for equal fingerprints."""
    total = 0.0
    for w, ((ta, xa), (tb, xb)) in enumerate(zip(a.walks, b.walks)):
        end = max(ta, tb)
        if not end:
            total += 1.0
            continue
        both, longer = min(len(xa), len(xb)), max(len(xa), len(xb))
        value = np.zeros(longer)
        value[:both] = np.where(xa[:both] == xb[:both], 1.0, -1.0)
        weight = np.ones(longer)
        if longer > 256:
            shell = (np.arange(longer - 256)) // SHELL_BITS
            size = np.bincount(shell)
            low = 256 << np.arange(len(size))
            share = np.minimum(2 * low, end) - low
            weight[256:] = (share / size)[shell]
        total += float((weight * value).sum() / weight.sum())
    return min(1.0, max(0.0, total / len(a.walks)))


def _runs(texts: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Consecutive texts of about RUN_CHARS characters together."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs_with_successor(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows; the last of each run (of two or more) is the first of the next."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2])
        if size >= RUN_CHARS and len(held) > 1:
            yield held
            held, size = [r], len(r[2])
    if len(held) > 1:
        yield held
    elif held and not held[0][3]:
        raise RuntimeError(f"range {held[0][0]} lacks its successor")


# --------------------------------------------------------------------- per-text results
def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every row: one narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = []
            for run in _runs(codes(t or "") for t in b.column("text").to_pylist()):
                prints += prints_of(run)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([p.chars for p in prints], pa.int64()),
                 pa.array([str(p) for p in prints], pa.string())], names=[id_col, "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n_chars long, fingerprint string")


def _with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, id, packed, tie, extra): ranges in id order, texts compressed for the shuffle; ``extra`` rows are the first document of
    the range after (after the last: of the first one), one distinct text each."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = ids.filter(F.col("id").isNotNull())
    # Four ranges a partition: hashing deals them out more evenly.
    low = sorted(r["low"] for r in known.repartitionByRange(4 * parts, "id").groupBy(
        F.spark_partition_id().alias("p")).agg(F.min("id").alias("low")).collect())
    nulls = ids.filter(F.col("id").isNull()).limit(1).count() > 0
    borders = np.array(low, dtype=np.int64)
    last = len(borders) - 1 + nulls  # null ids: one more range at the end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.column("id")
            missing = i.is_null().to_numpy(zero_copy_only=False)
            at = np.searchsorted(borders, i.fill_null(0).to_numpy(zero_copy_only=False), side="right") - 1
            at[missing] = last
            first = np.zeros(len(at), dtype=bool)
            if len(borders):
                first = ~missing & (borders[np.clip(at, 0, len(borders) - 1)]
                                    == i.fill_null(0).to_numpy(zero_copy_only=False))
            if nulls:
                first |= missing
            again = np.flatnonzero(first)
            rows = np.concatenate([np.arange(len(at)), again])
            where = np.concatenate([at, np.where(at[again] == 0, last, at[again] - 1)])
            extra = np.arange(len(rows)) >= len(at)
            press = zstandard.ZstdCompressor(level=1)
            packed = pa.array([press.compress(t.encode()) for t in b.column("text").to_pylist()], pa.binary())
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), i.take(take), packed.take(take), b.column("tie").take(take),
                 pa.array(extra)], names=["range", "id", "packed", "tie", "extra"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                       F.xxhash64(text).alias("tie"))
    return rows.mapInArrow(tidy(run), "range int, id long, packed binary, tie long, extra boolean")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    bands_edited, bands_next) of every row.

    The edited text is the text with its last floor(n/2) characters replaced by the first
    as many (or all) of the next document by id.  ``bands_``: how many of the bands of
    ``edit_classes`` (16 bits, 16 bands a shell) both texts share.
    """
    def results(rows: Iterator[tuple]) -> Iterator[tuple]:
        """rows in order: (range, id, text, extra); a row's successor is the row after it."""
        for run in _runs_with_successor(rows):
            texts = [codes(r[2]) for r in run]
            made = edited_prints(texts)
            last = prints_of(texts[-1:])[0]
            bands = [set(band_keys(p, 16, 16)) for p in (*(mine for mine, _ in made), last)]
            for n, (mine, edited) in enumerate(made):
                where, i, _, extra = run[n]
                if extra:
                    continue
                if run[n + 1][0] != where:
                    raise RuntimeError(f"range {where} lacks its successor")
                after = made[n + 1][0] if n + 1 < len(made) else last
                half = len(texts[n]) // 2
                sha = hashlib.sha256(texts[n][:len(texts[n]) - half].tobytes().decode(
                    "utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"))
                sha.update(texts[n + 1][:half].tobytes().decode("utf-32-le", "surrogatepass").encode(
                    "utf-8", "surrogatepass"))
                yield (i, len(texts[n]), sha.hexdigest(), str(mine), str(edited), likeness(mine, edited),
                       likeness(mine, after), len(bands[n].intersection(band_keys(edited, 16, 16))),
                       len(bands[n] & bands[n + 1]))

    kinds = [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
             ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
             ("near_edited", pa.float64()), ("near_next", pa.float64()),
             ("bands_edited", pa.int32()), ("bands_next", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            over = None  # an extra row already seen: further ones of the range are later texts
            unpack = zstandard.ZstdDecompressor()
            for b in batches:
                for where, i, packed, extra in zip(*(b.column(c).to_pylist() for c in (
                        "range", "id", "packed", "extra"))):
                    if extra and over == where:
                        continue
                    over = where if extra else None
                    yield where, i, unpack.decompress(packed).decode(), extra

        held = []
        for r in results(rows()):
            held.append(r)
            if len(held) >= 1000:
                yield _rows(held, kinds)
                held = []
        if held:
            yield _rows(held, kinds)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _with_successors(docs, id_col, text_col).repartition(parts, "range").sortWithinPartitions(
        "range", "extra", F.col("id").asc_nulls_last(), "tie")
    out = dealt.mapInArrow(tidy(run), "id long, n_chars long, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double, "
                           "bands_edited int, bands_next int")
    return out.withColumnRenamed("id", id_col)


def _rows(rows: list[tuple], kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)],
                                      names=[n for n, _ in kinds])


# ------------------------------------------------------------- banding and verification
_picks: dict[tuple, np.ndarray] = {}


def _shell_bits(p: Print) -> Iterator[tuple[int, np.ndarray]]:
    """The two last shells that both walks cover, with their bits."""
    end = min(t for t, _ in p.walks)
    last = end.bit_length() - 2  # shell [2**s, 2**(s+1)) ends at or before ``end``
    for s in range(last, max(last - 2, -1), -1):
        if s < 8:
            yield s, np.concatenate([b[1 << s:2 << s] for _, b in p.walks])
        else:
            at = 256 + (s - 8) * SHELL_BITS
            yield s, np.concatenate([b[at:at + SHELL_BITS] for _, b in p.walks])


def band_keys(p: Print, bits: int, bands: int) -> list[int]:
    """64-bit keys: shell, band and the bits sampled for it."""
    out = []
    for s, have in _shell_bits(p):
        pick = _picks.get((s, bits, bands))
        if pick is None:
            pick = np.random.RandomState([_SEED, s, bits]).randint(0, len(have), (bands, bits))
            _picks[(s, bits, bands)] = pick
        for i, packed in enumerate(np.packbits(have[pick], axis=1)):
            raw = hashlib.blake2b(packed.tobytes(), digest_size=8, key=b"%d.%d" % (s, i)).digest()
            out.append(int.from_bytes(raw, "little", signed=True))
    return out


def band_plan(texts: int, at_least: float, recall: float) -> tuple[int, int]:
    """(bits, bands): bits for about one chance candidate a text, bands for the recall."""
    unlike = 0.5 + 0.5 * 0.1  # chance agreement of bits of unlike natural texts
    bits = min(96, max(16, math.ceil(math.log(max(texts, 2)) / -math.log(unlike))))
    same = (0.5 + 0.5 * at_least) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def edit_classes(docs: DataFrame, at_least: float = 0.9, recall: float = 0.95, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links): texts joined by links of likeness ``at_least`` or more.

    ``class_id`` is the least id of the class, ``n_links`` the links verified at the row's text
    (0 without any).  Rows of equal fingerprint are one text; null ids take no part.
    """
    from stratum.llm.components import connected

    prints = fingerprints(docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id")
    prints = stored(prints.drop("n_chars"), "prints")
    texts = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("rep")), "texts")
    bits, bands = band_plan(texts.count(), at_least, recall)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, p in zip(b.column("rep").to_pylist(), b.column("fingerprint").to_pylist()):
                k = sorted(set(band_keys(Print.parse(p), bits, bands)))
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array([i] * len(k), pa.int64())],
                                                 names=["key", "rep"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [likeness(Print.parse(x), Print.parse(y)) >= at_least
                    for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("centre"), pa.array(near, pa.bool_())],
                                             names=["rep", "centre", "near"])

    left = stored(texts.mapInArrow(tidy(keys), "key long, rep long"), "bands")
    found = None
    while True:
        # One member is the centre of its group; groups of one text are done.
        centres = left.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("top")).filter(
            "centre < top").select("key", "centre")
        open_ = stored(left.join(centres, "key").filter("rep <> centre"), "open")
        pairs = open_.select("rep", "centre").distinct()
        pairs = pairs.join(texts.select("rep", F.col("fingerprint").alias("x")), "rep").join(
            texts.select(F.col("rep").alias("centre"), F.col("fingerprint").alias("y")), "centre")
        judged = stored(pairs.mapInArrow(tidy(verify), "rep long, centre long, near boolean"), "judged")
        links = judged.filter("near").select("rep", "centre")
        found = links if found is None else found.unionByName(links)
        left = stored(open_.join(judged.filter("NOT near"), ["rep", "centre"]).select("key", "rep"), "bands")
        if left.isEmpty():
            break
    links = stored(found.distinct(), "links")
    classes = connected(links, "edit")
    degree = links.select(F.explode(F.array("rep", "centre")).alias("rep")).groupBy("rep").agg(
        F.count(F.lit(1)).alias("n_links"))
    per_text = texts.join(classes.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left").select(
        "fingerprint", F.coalesce("component", "rep").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return prints.join(per_text, "fingerprint").select(
        F.col("id").alias(id_col), "class_id", "n_links")
