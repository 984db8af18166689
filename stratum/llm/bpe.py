"""Byte-level BPE encoding and decoding with a published rank file.

A text is cut by the tokenizer's pattern; each piece is merged on its own:
always the adjacent pair whose joined bytes have the lowest rank, the leftmost
of equals.  The candidate pairs of a piece stand at the leaves of a segment tree
over byte positions; a node holds the least ``rank * 2**32 + position`` below it,
so the root is the leftmost pair of minimum rank.  One merge changes three
leaves at most (the merged pair and its live neighbours), each a logarithmic
point update; live neighbours are kept in a doubly linked list of positions.

Two forms of the same tree: ``encode_pieces`` advances many pieces of one size
class together (numpy arrays, one row per piece), ``encode_long`` one long piece
with lists, O(n log n) also for a piece of a million bytes without a space.

Scale: one narrow pass; no shuffle.  The rank file (0.8 MB, fixed) is read once
on the driver and broadcast, so executors need no copy of it.  Each Python worker
remembers at most ``CACHE`` encoded pieces (about 40 MB), then starts anew.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import tidy

CACHE_BITS = 20
CACHE = 1 << (CACHE_BITS - 1)
LONG_PIECE = 64  # bytes; longer pieces take the list form
NONE = np.int64(1) << np.int64(62)  # no pair here
SHIFT = 32


class IntTable:
    """Open-addressing map of int64 keys to int64 values, vectorised; keys are not -1."""

    def __init__(self, bits: int):
        self.bits, self.mask = bits, np.int64((1 << bits) - 1)
        self.drop = np.uint64(64 - bits)
        self.clear()

    def clear(self) -> None:
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.vals = np.full(1 << self.bits, NONE, dtype=np.int64)
        self.used = 0

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.drop).view(np.int64)

    def put(self, key: np.ndarray, val: np.ndarray) -> None:
        """Add distinct keys that are not present yet."""
        self.used += len(key)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):  # of the keys that want a free slot one gets it, the rest move on
            s = slot[todo]
            free = self.keys[s] == -1
            self.keys[s[free]] = key[todo[free]]
            won = self.keys[s] == key[todo]
            self.vals[s[won]] = val[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self.mask

    def get(self, key: np.ndarray) -> np.ndarray:
        """Values; NONE where a key is absent."""
        slot = self._slot(key)
        have = self.keys[slot]
        out = np.where(have == key, self.vals[slot], NONE)
        todo = np.flatnonzero((have != key) & (have != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            have = self.keys[slot[todo]]
            hit = have == key[todo]
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (have != -1)]
        return out


class PairTable:
    """(left id, right id) -> id of the joined token."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << SHIFT) | b] = r
        n = len(pairs)
        self.table = IntTable(max(4, int(np.ceil(np.log2(4 * max(1, n))))))
        self.table.put(np.fromiter(pairs.keys(), dtype=np.int64, count=n),
                       np.fromiter(pairs.values(), dtype=np.int64, count=n))
        self._pairs: dict[int, int] | None = None

    def pairs(self) -> dict[int, int]:
        """The same map as a dictionary, made when the first long piece asks for it."""
        if self._pairs is None:
            used = np.flatnonzero(self.table.keys != -1)
            self._pairs = dict(zip(self.table.keys[used].tolist(), self.table.vals[used].tolist()))
        return self._pairs

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.table.get((a << SHIFT) | b)


# Fixed value: the pattern for which pieces are cut with arrays; any other pattern
# goes through the regex library.
ARRAY_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
                 r"""|\s+(?!\S)|\s+""")
# Letters and numbers that Unicode 16.0 added after 15.1.  The library
# whose tokens are matched knows 16.0; characters assigned later count as other.
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
    (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
    (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0),
    (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
]
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point, asked from the regex library once per process."""
    if not _classes:
        import regex

        table = np.full(0x110000, OTHER, dtype=np.uint8)
        code = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        text, index = "".join(map(chr, code)), np.array(code)
        for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(name, text):
                table[index[m.start():m.end()]] = kind
        known = np.array([unicodedata.category(c) != "Cn" for c in text])
        late = np.zeros(0x110000, dtype=bool)
        late[index[~known]] = True
        for a, b in UNICODE_16:
            late[a:b + 1] = False
        table[late & (table != SPACE)] = OTHER
        _classes.append(table)
    return _classes[0]


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a piece of ARRAY_PATTERN starts, for a run of texts.

    The pattern read as boundaries: a run of one class starts a piece unless a
    space directly before joins it; a run of white space starts one, and so does
    its last character when other text follows; a lone apostrophe that starts a
    piece takes one of the seven endings with it.
    """
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each character
    n = len(cp)
    kind = char_classes()[cp]
    edge = np.zeros(n + 1, dtype=bool)  # a text begins here
    edge[np.searchsorted(at, offsets)] = True
    head = edge.copy()  # a run begins here
    head[1:n] |= kind[1:] != kind[:-1]
    head[n] = True
    space = kind == SPACE
    joined = np.zeros(n, dtype=bool)
    joined[1:] = (cp[:-1] == 0x20) & ~edge[1:n]
    start = head[:n] & (space | ~joined)
    last = space & head[1:] & ~edge[1:]
    start |= last
    quote = np.flatnonzero((cp == 0x27) & start & ~space & head[:n] & head[1:])
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~edge[quote + 1]]
    if len(quote):
        c1 = cp[quote + 1]
        two = np.minimum(quote + 2, n - 1)
        c2 = np.where((quote + 2 < n) & ~edge[two], cp[two], 0)
        size = np.where(np.isin(c1, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size[(c1 == ord(a)) & (c2 == ord(b))] = 3
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + size
        rest = rest[rest < n]
        start[rest[(kind[rest] == LETTER)]] = True
    return at[start]


class Encoder:
    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        self.ranks = {base64.b64decode(t): int(r) for t, r in
                      (line.split() for line in rank_file.splitlines() if line.strip())}
        self.pattern, self.split = pattern, regex.compile(pattern).findall
        self.table = PairTable(self.ranks)
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        top = max(self.ranks.values()) + 1
        tokens = [b""] * top
        for t, r in self.ranks.items():
            tokens[r] = t
        self.vocab = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.vocab_size = np.fromiter(map(len, tokens), dtype=np.int64, count=top)
        self.vocab_at = np.cumsum(self.vocab_size) - self.vocab_size
        self.known = IntTable(CACHE_BITS)
        self._reset()

    # -- one size class, all pieces together -------------------------------
    def encode_pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece as packed little-endian uint32; pieces of 2 bytes or more."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        longest = int(size.max())
        leaves = 1 << max(1, int(longest - 1).bit_length())  # pair i stands at leaf i
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        off = np.concatenate([[0], np.cumsum(size)])
        col = np.arange(leaves + 1)
        inside = col[None, :] < size[:, None]
        ids = np.full((n, leaves + 1), -1, dtype=np.int64)
        ids[inside] = self.byte_id[data]
        nxt = np.tile(col + 1, (n, 1))
        prv = np.tile(col - 1, (n, 1))
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
        pair = inside[:, 1:leaves + 1]
        r = self.table.rank(ids[:, :leaves][pair], ids[:, 1:leaves + 1][pair])
        lv = np.full((n, leaves), NONE, dtype=np.int64)
        lv[pair] = np.where(r == NONE, NONE, (r << SHIFT) | np.broadcast_to(col[:leaves], (n, leaves))[pair])
        tree[:, leaves:] = lv
        h = leaves
        while h > 1:
            tree[:, h // 2:h] = np.minimum(tree[:, h:2 * h:2], tree[:, h + 1:2 * h:2])
            h //= 2
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            i = root & np.int64((1 << SHIFT) - 1)
            j = nxt[rows, i]  # the right half, which dies
            ids[rows, i] = root >> SHIFT
            after = nxt[rows, j]
            nxt[rows, i] = after
            ids[rows, j] = -1
            has_after = after < size[rows]
            prv[rows[has_after], after[has_after]] = i[has_after]
            before = prv[rows, i]
            has_before = before >= 0
            self._set(tree, leaves, rows, j, np.full(len(rows), NONE))
            self._pairs(tree, leaves, rows, i, after, has_after, ids)
            self._pairs(tree, leaves, rows[has_before], before[has_before], i[has_before],
                        np.ones(int(has_before.sum()), dtype=bool), ids)
            rows = rows[tree[rows, 1] != NONE]
        kept = (ids >= 0) & inside
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        out, at = [], 0
        for e in ends.tolist():
            out.append(flat[at:e])
            at = e
        return out

    def _pairs(self, tree, leaves, rows, left, right, valid, ids) -> None:
        value = np.full(len(rows), NONE, dtype=np.int64)
        v = np.flatnonzero(valid)
        if len(v):
            r = self.table.rank(ids[rows[v], left[v]], ids[rows[v], right[v]])
            value[v] = np.where(r == NONE, NONE, (r << SHIFT) | left[v])
        self._set(tree, leaves, rows, left, value)

    @staticmethod
    def _set(tree, leaves, rows, leaf, value) -> None:
        node = leaf + leaves
        ok = leaf < leaves  # the last position has no pair leaf
        if not ok.all():
            rows, node, value = rows[ok], node[ok], value[ok]
        tree[rows, node] = value
        while len(node) and node[0] > 1:  # all leaves have one depth
            value = np.minimum(value, tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value

    # -- one long piece ----------------------------------------------------
    def encode_long(self, piece: bytes) -> bytes:
        n = len(piece)
        none, get, mask = int(NONE), self.table.pairs().get, (1 << SHIFT) - 1
        ids = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        leaves = 1 << max(1, (n - 1).bit_length())
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            r = get((ids[i] << SHIFT) | ids[i + 1])
            if r is not None:
                tree[leaves + i] = (r << SHIFT) | i
        for k in range(leaves - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            k = leaf + leaves
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    return
                tree[k] = value

        while tree[1] != none:
            root = tree[1]
            i = root & mask
            j = nxt[i]
            ids[i] = root >> SHIFT
            ids[j] = -1
            after = nxt[i] = nxt[j]
            put(j, none)
            value = none
            if after < n:
                prv[after] = i
                r = get((ids[i] << SHIFT) | ids[after])
                if r is not None:
                    value = (r << SHIFT) | i
            put(i, value)
            before = prv[i]
            if before >= 0:
                r = get((ids[before] << SHIFT) | ids[i])
                put(before, none if r is None else (r << SHIFT) | before)
        a = np.array(ids, dtype=np.int64)
        return a[a >= 0].astype("<u4").tobytes()

    # -- texts ---------------------------------------------------------------
    def _encode_new(self, raws: list[bytes]) -> list[bytes]:
        """Packed ids of distinct pieces."""
        out: list[bytes] = [b""] * len(raws)
        by_size: dict[int, list[int]] = {}
        for i, raw in enumerate(raws):
            whole = self.ranks.get(raw)  # a piece that is a token stays one
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                out[i] = self.encode_long(raw)
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append(i)
        for rows in by_size.values():
            for k in range(0, len(rows), 8192):
                part = rows[k:k + 8192]
                for i, ids in zip(part, self.encode_pieces([raws[i] for i in part])):
                    out[i] = ids
        return out

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.pattern == ARRAY_PATTERN:
            return cut_pieces(data, offsets)
        starts = []
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for p in self.split(data[lo:hi].tobytes().decode("utf-8")):
                starts.append(lo)
                lo += len(p.encode("utf-8"))
        return np.array(starts, dtype=np.int64)

    def _reset(self) -> None:
        self.known.clear()
        self.store = np.zeros(1 << 16, dtype=np.uint32)
        self.begin, self.size, self.fill = [], [], 0
        self.begin_a = self.size_a = np.zeros(0, dtype=np.int64)

    def _remember(self, keys: np.ndarray, packed: list[bytes]) -> None:
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        size = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        while self.fill + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.fill:self.fill + len(ids)] = ids
        at = len(self.begin_a)
        self.begin_a = np.concatenate([self.begin_a, self.fill + np.cumsum(size) - size])
        self.size_a = np.concatenate([self.size_a, size])
        self.fill += len(ids)
        self.known.put(keys, np.arange(at, at + len(keys)))

    def encode_flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text) of a run of texts.

        Distinct pieces are encoded once and remembered by a 64-bit hash; the
        caller decodes anyway, so a hash collision shows and is repaired there.
        """
        from stratum.llm.textops import mix, prefix_hash, span_hash

        start = self._cut(data, offsets)
        end = np.append(start[1:], len(data))
        key = span_hash(prefix_hash(data), start, end)
        key = (mix(key + (end - start).astype(np.uint64)) >> np.uint64(1)).view(np.int64)
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if self.known.used + len(uniq) > CACHE:
            self._reset()
        if len(uniq) > CACHE:  # only with a text far beyond the block size
            self.known = IntTable(int(np.ceil(np.log2(2 * len(uniq)))))
            self._reset()
        row = self.known.get(uniq)
        new = np.flatnonzero(row == NONE)
        if len(new):
            raws = [data[start[i]:end[i]].tobytes() for i in first[new]]
            self._remember(uniq[new], self._encode_new(raws))
            row = self.known.get(uniq)
        row = row[inverse]
        size = self.size_a[row]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.store[np.repeat(self.begin_a[row] - stop + size, size) + np.arange(total)]
        bounds = np.concatenate([[0], stop])[np.searchsorted(start, offsets)]
        bounds[-1] = total
        if self.known.bits > CACHE_BITS:
            self.known = IntTable(CACHE_BITS)
            self._reset()
        return ids, bounds

    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        return self.encode_flat(raw, np.array([0, len(raw)]))[0]

    def encode_plain(self, text: str) -> np.ndarray:
        """Without the piece memory: the repair path."""
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        start = self._cut(data, np.array([0, len(data)])).tolist()
        raws = [data[a:b].tobytes() for a, b in zip(start, [*start[1:], len(data)])]
        return np.frombuffer(b"".join(self._encode_new(raws)), dtype="<u4")

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of an id sequence."""
        size = self.vocab_size[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        return self.vocab[np.repeat(self.vocab_at[ids] - stop + size, size) + np.arange(total)]


_encoders: dict[str, Encoder] = {}


def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One encoder per process and rank file."""
    key = hashlib.sha256(rank_file + b"\0" + pattern.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


TEXT_BYTES = 1 << 20  # texts encoded together


def bpe_tokens(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, token_ids]): encode, then decode.

    ``token_ids`` is the id sequence as packed little-endian uint32 (binary).
    ``rank_path`` is read on the driver (a vocabulary file of bounded size).
    A null text counts as empty: no tokens, both digests those of no bytes.
    Other input columns are ignored; repeated rows give repeated results.
    """
    with open(rank_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        enc = encoder(shared.value, pattern)
        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off, TEXT_BYTES):
                part, bounds = data[off[i]:off[j]], off[i:j + 1] - off[i]
                ids, first = enc.encode_flat(part, bounds)
                n, sums, back, packed = [], [], [], []
                for k in range(j - i):
                    x = ids[first[k]:first[k + 1]]
                    raw, text = enc.decode(x).tobytes(), part[bounds[k]:bounds[k + 1]].tobytes()
                    if raw != text:
                        x = enc.encode_plain(text.decode("utf-8"))
                        raw = enc.decode(x).tobytes()
                    x = x.astype("<u4").tobytes()
                    n.append(len(x) // 4)
                    sums.append(hashlib.sha256(x).hexdigest())
                    back.append(hashlib.sha256(raw).hexdigest())
                    if keep_ids:
                        packed.append(x)
                cols = [b.column("id").slice(i, j - i), pa.array(n, pa.int64()),
                        pa.array(sums, pa.string()), pa.array(back, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols.append(pa.array(packed, pa.binary()))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
             + (", token_ids binary" if keep_ids else ""))


def standard_ranks() -> tuple[str, str]:
    """(rank file, pattern) of the public 50k vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
