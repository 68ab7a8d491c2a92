"""Exact substring deduplication with suffix arrays by induced sorting.

A byte goes if a string of ``width`` bytes that covers it also starts in a document of
smaller id. Every string of that width holds a minimiser: its leftmost 16-gram of least
hash. Its key is the minimiser with the 17 bytes on its left, or if it begins too early
those on its right. Strings that are equal have equal keys at equal places, so stretches of
successive strings with one key can be settled by themselves. First only hashes of
keys travel, and tell which stretches have a key that another document has
too (16 bytes alone recur by chance, in ever more texts as a table grows). Only those are
sent on, to the shard of their key, where all equal strings meet. Before each step a slice of the input settles what it can: of equal texts, and of
equal stretches, only that of the smallest id goes out; the others are covered already.

A shard keeps each distinct stretch once and builds suffix arrays over them: suffixes are classified, the leftmost smaller ones are
sorted by induction and named, equal names are told apart by prefix doubling, and the array is
induced from them in linear time, bucket by bucket in numpy. Permuted common prefixes
then give the runs of equal strings, and each run its smallest document. Stretches of one
key that do not fit an array are sorted string by string, those of one place at a time.

Null texts count as empty. Documents without id stand behind all others and are not
smaller than each other; nor are rows of one id. Repeated rows get equal results. Texts
shorter than the width stay. Extra columns are not read. Longer texts are cut into
overlapping pieces that fit a slice; a table without rows gives one without rows. Texts that
share an id, or have none, are told apart by 64 bits of hash: 10^9 of them hold a clash with
odds of 0.03, and then the two have the bytes of either removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import session_limits, slices, table, written

WIDTH, GRAM = 50, 16
SLICE = 2 << 20  #: bytes of text that a slice settles at once; positions in it fit 24 bits
ASK_SHARD, SEND_SHARD = 48 << 20, 10 << 20  #: bytes of texts whose hashes, or stretches, a shard is to hold
BATCH = 2 << 20  #: bytes of one suffix array, unless one minimiser needs more
LAST = np.iinfo(np.int64).max


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the end counts as smallest)."""
    n = len(t)
    less = np.zeros(n, dtype=bool)
    less[:-1] = t[:-1] < t[1:]
    same = np.zeros(n, dtype=bool)
    same[:-1] = t[:-1] == t[1:]
    nxt = np.where(same, n, np.arange(n))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    return less[nxt]


def _spread(found: np.ndarray, chars: np.ndarray, lists: list[list]) -> None:
    """Append positions to the bucket of their character, in order."""
    if len(found) == 0:
        return
    order = np.argsort(chars, kind="stable")
    found, chars = found[order], chars[order]
    cuts = np.flatnonzero(np.diff(chars)) + 1
    for part, c in zip(np.split(found, cuts), chars[np.concatenate(([0], cuts))].tolist()):
        lists[c].append(part)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The order of all suffixes that the order ``lms`` of leftmost smaller ones induces."""
    n = len(t)
    none = np.empty(0, dtype=np.int64)
    seeds: list[list] = [[] for _ in range(k)]
    _spread(lms, t[lms], seeds)
    large: list[list] = [[] for _ in range(k)]
    done_l: list[np.ndarray] = []
    large[int(t[n - 1])].append(np.array([n - 1]))  # the end, smaller than all, induces the last suffix
    for c in range(k):
        settled = []
        while large[c]:
            batch, large[c] = np.concatenate(large[c]), []
            settled.append(batch)
            before = batch[batch > 0] - 1
            before = before[~small[before]]
            _spread(before, t[before], large)
        done_l.append(np.concatenate(settled) if settled else none)
        if seeds[c]:
            before = np.concatenate(seeds[c])
            before = before[before > 0] - 1
            before = before[~small[before]]
            _spread(before, t[before], large)
    smaller: list[list] = [[] for _ in range(k)]
    out: list[np.ndarray] = []
    for c in range(k - 1, -1, -1):
        settled = []
        while smaller[c]:
            batch, smaller[c] = np.concatenate(smaller[c]), []
            settled.append(batch)
            before = batch[batch > 0] - 1
            before = before[small[before]]
            _spread(before, t[before], smaller)
        before = done_l[c][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        _spread(before, t[before], smaller)
        down = np.concatenate([*settled, done_l[c][::-1]]) if settled else done_l[c][::-1]
        out.append(down)
    return np.concatenate(out)[::-1]


def _names(t: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names, ascending along ``order``, of the substrings t[i .. i + length[i]]; equal ones share theirs."""
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    at = 0
    while len(live):
        eq = t[a[live] + at] == t[b[live] + at]
        same[live[~eq]] = False
        live = live[eq]
        at += 1
        live = live[length[a[live]] >= at]
    return np.concatenate(([0], np.cumsum(~same)))


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """The order of the suffixes of a string of names, by prefix doubling, ``depth`` names deep."""
    n, h = len(names), 1
    rank = names.astype(np.int64)
    while True:
        top = int(rank.max()) + 2
        nxt = np.zeros(n, dtype=np.int64)
        nxt[: n - h] = rank[h:] + 1
        key = rank * top + nxt
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        h *= 2
        if rank[order[-1]] == n - 1 or h >= min(depth, n):
            return order


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Order of the suffixes of bytes ``t``; with ``depth``, equal up to so many bytes may come in any order."""
    n = len(t)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    k = int(t.max()) + 1
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        first = _induce(t, small, lms, k)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        order = first[is_lms[first]]
        length = np.zeros(n, dtype=np.int64)
        length[lms[:-1]] = np.diff(lms)
        length[lms[-1]] = n  # the one that runs into the end is like no other
        by_place = np.empty(n, dtype=np.int64)
        by_place[order] = _names(t, order, length)
        names = by_place[lms]
        if names.max() + 1 < len(lms):
            lms = lms[_doubled(names, len(lms) if depth is None else depth // 2 + 1)]
        else:
            lms = order
    return _induce(t, small, lms, k)


def permuted_prefixes(t: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By text position: bytes that a suffix shares with the one before it in ``order``, ``most`` at most."""
    words = words8(np.concatenate((t, np.zeros(most, dtype=np.uint8))))
    shared = np.zeros(len(t), dtype=np.int64)
    at, before = order[1:], order[:-1]
    for i in range(0, most, 8):
        differ = words[at + i] ^ words[before + i]
        equal = np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3  # whole bytes below the lowest differing bit
        shared[at] += np.where(differ == 0, 8, equal)
        at, before = at[differ == 0], before[differ == 0]
        if not len(at):
            break
    return np.minimum(shared, most)


def words8(raw: np.ndarray) -> np.ndarray:
    """The eight bytes at every position, as one number (zeros behind the end)."""
    w = np.concatenate((raw, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    w = w[:-1] | w[1:] << np.uint64(8)
    w = w[:-2] | w[2:] << np.uint64(16)
    return (w[:-4] | w[4:] << np.uint64(32))[: len(raw)]


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes at every position."""
    w = words8(raw)
    v = np.concatenate((w[8:], np.zeros(min(8, len(w)), dtype=np.uint64)))
    h = w * np.uint64(0x9E3779B97F4A7C15) ^ (v * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def side_of(width: int) -> int:
    """Bytes of a key beside the minimiser: a window of ``width`` has so many on its left or on its right."""
    return (width - GRAM) // 2


def key_hashes(gram_hash, at: np.ndarray, side: int) -> np.ndarray:
    """A 64-bit hash of the GRAM + ``side`` bytes at every place in ``at``; ``gram_hash`` gives that of the 16 at places."""
    mixed = gram_hash(at)
    for i in (*range(GRAM, side, GRAM), side):
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) + gram_hash(at + i)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def stretches(raw: np.ndarray, valid: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every stretch of valid windows with one key, its place and hash.

    Windows of one minimiser are split where it passes their middle: before, the key is the
    minimiser with the bytes on its left, then with those on its right.
    """
    n = len(raw) - width + 1
    if n <= 0 or not valid[:n].any():
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    h = gram_hashes(raw)
    low = np.uint64((1 << 24) - 1)
    key = h & ~low | np.arange(len(h), dtype=np.uint64)
    span, have, best = width - GRAM + 1, 1, key
    while have * 2 <= span:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < span:
        best = np.minimum(best[: len(best) - (span - have)], best[span - have :])
    place = (best[:n] & low).astype(np.int64)
    side = side_of(width)
    place -= np.where(place - np.arange(n) >= side, side, 0)
    ok = valid[:n]
    fresh = ok.copy()
    fresh[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
    first = np.flatnonzero(fresh)
    ends = ok.copy()
    ends[:-1] &= (place[1:] != place[:-1]) | ~ok[1:]
    return first, np.flatnonzero(ends), place[first], key_hashes(h.__getitem__, place[first], side)


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _pack_bytes(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x)


def _unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


_ASK = ["shard", "docs", "marks", "doc", "number", "hash"]
_SEND = ["shard", "docs", "marks", "doc", "start", "length", "place", "body"]


def _blob_sql(names: list[str]) -> str:
    return ", ".join(f"{n} {'int' if n == 'shard' else 'binary'}" for n in names)


def _blobs(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.int32() if n == "shard" else pa.binary()) for n in names]))


class Slice:
    """Pieces (ord, mark of the text, offset in it, bytes) of some documents, laid end to end, with their stretches."""

    def __init__(self, pieces: list[tuple], width: int):
        pieces = sorted(pieces, key=lambda p: p[:3])
        self.width = width
        #: intervals of texts that equal one of a smaller id
        self.covered: list[tuple[int, int, int, int]] = []
        kept, seen = [], {}
        for p in pieces:
            if len(p[3]) < width:
                continue
            owner = seen.setdefault((p[2], p[3]), p)
            if owner is p:
                kept.append(p)
            elif owner[0] < p[0]:
                self.covered.append((p[0], p[1], p[2], p[2] + len(p[3])))
            elif owner[:3] != p[:3]:
                kept.append(p)
        self.pieces = kept
        self.raw = b"".join([p[3] for p in kept])
        sizes = np.array([len(p[3]) for p in kept], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.begins = ends - sizes
        valid = np.ones(len(self.raw), dtype=bool)
        for e in ends.tolist():
            valid[e - width + 1 : e] = False
        self.first, last, self.place, self.hash = stretches(np.frombuffer(self.raw, dtype=np.uint8), valid, width)
        self.end = last + width
        self.doc = np.searchsorted(ends, self.first, side="right")
        self.base = np.searchsorted(self.doc, np.arange(len(kept)))
        self.ords = np.array([p[0] for p in kept], dtype=np.int64)
        self.marks = np.array([p[1] for p in kept], dtype=np.int64)
        self.offsets = np.array([p[2] for p in kept], dtype=np.int64)
        self.start = self.first - self.begins[self.doc] + self.offsets[self.doc] if len(kept) else self.first

    def numbers(self) -> np.ndarray:
        """A number for every stretch within its text, the same in any slice."""
        return self.offsets[self.doc] * 2 + np.arange(len(self.doc)) - self.base[self.doc] if len(self.doc) else self.first

    def by_shard(self, pick: np.ndarray, shards: int) -> Iterator[tuple[dict, np.ndarray]]:
        """The part of a blob that tells whose stretches it holds, and the positions in ``pick``, for each shard."""
        shard = (self.hash[pick] >> np.uint64(32)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        for idx in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else ():
            own, local = np.unique(self.doc[pick[idx]], return_inverse=True)
            yield {"shard": int(shard[idx[0]]), "docs": _packed(np.diff(self.ords[own], prepend=0)), "marks": _packed(self.marks[own]), "doc": _packed(np.diff(local, prepend=0).astype(np.int32))}, idx


def ask_slice(part: Slice, shards: int) -> list[dict]:
    """A blob a shard of the minimisers' hashes."""
    every, number = np.arange(len(part.doc)), part.numbers()
    return [head | {"number": _packed(np.diff(number[idx], prepend=0)), "hash": _packed(part.hash[idx].astype(np.uint32))} for head, idx in part.by_shard(every, shards)]


def send_slice(part: Slice, wanted: list[np.ndarray | None], shards: int) -> tuple[list[tuple[int, int, int, int]], list[dict]]:
    """Intervals covered by stretches of smaller ids in the slice, and a blob a shard of the other wanted stretches.

    wanted: for each piece the sorted numbers of the stretches to send.
    """
    number, use = part.numbers(), np.zeros(len(part.doc), dtype=bool)
    for i, w in enumerate(wanted):
        if w is not None:
            a, b = part.base[i], part.base[i + 1] if i + 1 < len(part.base) else len(part.doc)
            use[a:b] = np.isin(number[a:b], w)
    covered, known, send, segments = [], {}, [], []
    ords, marks, doc = part.ords, part.marks, part.doc
    for i in np.flatnonzero(use).tolist():
        a, b = int(part.first[i]), int(part.end[i])
        s = part.raw[a:b]
        j = known.setdefault(s, i)
        if j == i or ords[doc[j]] == ords[doc[i]]:
            send.append(i)
            segments.append(s)
        else:
            at = int(part.start[i])
            covered.append((int(ords[doc[i]]), int(marks[doc[i]]), at, at + b - a))
    pick = np.array(send, dtype=np.int64)
    blobs = []
    for head, idx in part.by_shard(pick, shards):
        own = pick[idx]
        blobs.append(
            head
            | {
                "start": _packed(part.start[own].astype(np.int64)),
                "length": _packed((part.end[own] - part.first[own]).astype(np.int16)),
                "place": _packed((part.place[own] - part.first[own]).astype(np.uint8)),
                "body": _pack_bytes(b"".join([segments[i] for i in idx.tolist()])),
            }
        )
    return covered, blobs


def _owners(group: dict, i: int) -> tuple[np.ndarray, np.ndarray]:
    doc = np.cumsum(_unpacked(group["doc"][i], np.int32))
    return np.cumsum(_unpacked(group["docs"][i], np.int64))[doc], _unpacked(group["marks"][i], np.int64)[doc]


def shared_numbers(group: dict) -> tuple[list[int], list[int], list[bytes]]:
    """Of the asked hashes those of several ids: per text, the numbers of its stretches."""
    n = len(group["shard"])
    owners = [_owners(group, i) for i in range(n)]
    ords, marks = np.concatenate([o[0] for o in owners]), np.concatenate([o[1] for o in owners])
    number = np.concatenate([np.cumsum(_unpacked(group["number"][i], np.int64)) for i in range(n)])
    h = np.concatenate([_unpacked(group["hash"][i], np.uint32) for i in range(n)])
    order = np.argsort(h, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    several = np.minimum.reduceat(ords[order], heads) != np.maximum.reduceat(ords[order], heads)
    hit = order[np.repeat(several, np.diff(np.append(heads, len(order))))]
    if not len(hit):
        return [], [], []
    hit = hit[np.lexsort((number[hit], marks[hit], ords[hit]))]
    o, m = ords[hit], marks[hit]
    cuts = np.flatnonzero((o[1:] != o[:-1]) | (m[1:] != m[:-1])) + 1
    at = np.concatenate(([0], cuts))
    return o[at].tolist(), m[at].tolist(), [x.astype(np.int64).tobytes() for x in np.split(number[hit], cuts)]


def _smallest(contents: list[bytes], owners: np.ndarray, width: int) -> np.ndarray:
    """For every window of every content, one after another: the smallest owner of an equal window."""
    t = np.frombuffer(b"\xff".join(contents) + b"\xff", dtype=np.uint8)
    sizes = np.array([len(c) for c in contents])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    n_windows = sizes - width + 1
    content = np.repeat(np.arange(len(contents)), n_windows)
    at = begins[content] + np.arange(len(content)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    is_window = np.zeros(len(t), dtype=bool)
    is_window[at] = True
    order = suffix_array(t, depth=width)
    order = order[is_window[order]]
    fresh = permuted_prefixes(t, order, width)[order] < width
    fresh[0] = True
    owner = np.empty(len(t), dtype=np.int64)
    owner[at] = owners[content]
    runs = np.flatnonzero(fresh)
    least = np.minimum.reduceat(owner[order], runs)
    by_place = np.empty(len(t), dtype=np.int64)
    by_place[order] = np.repeat(least, np.diff(np.append(runs, len(order))))
    return by_place[at]


def _smallest_by_place(contents: list[bytes], owners: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """As ``_smallest``, for contents of one key at ``place``, too many for one suffix array.

    Equal windows have the key at equal places, so those of each place are sorted by themselves:
    a window a content at a time.
    """
    raw = np.frombuffer(b"".join(contents), dtype=np.uint8)
    n = np.array([len(c) for c in contents]) - width + 1
    begins, at = np.cumsum(n + width - 1) - (n + width - 1), np.cumsum(n) - n
    out = np.empty(int(n.sum()), dtype=np.int64)
    for before in range(int(place.max()) + 1):
        own = np.flatnonzero((place >= before) & (place - before < n))
        if len(own):
            first = place[own] - before
            window = raw[(begins[own] + first)[:, None] + np.arange(width)].view(f"V{width}").ravel()
            order = np.argsort(window, kind="stable")
            runs = np.flatnonzero(np.concatenate(([True], window[order][1:] != window[order][:-1])))
            least = np.minimum.reduceat(owners[own][order], runs)
            out[at[own[order]] + first[order]] = np.repeat(least, np.diff(np.append(runs, len(order))))
    return out


def settle_shard(ords: np.ndarray, marks: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray, body: bytes, width: int = WIDTH, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ord, mark, start, end of the intervals that stretches of smaller ids cover."""
    ends = np.cumsum(length)
    begins = ends - length
    raw = np.frombuffer(body, dtype=np.uint8)
    keys = np.empty(len(begins), dtype=np.uint64)
    for i in range(0, len(begins), 1 << 16):
        at = begins[i : i + (1 << 16)] + place[i : i + (1 << 16)]
        keys[i : i + (1 << 16)] = key_hashes(lambda x: gram_hashes(raw[x[:, None] + np.arange(GRAM)].ravel())[::GRAM], at, side_of(width))
    order = np.argsort(keys, kind="stable")
    g = keys[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = g[1:] != g[:-1]
    heads = np.flatnonzero(fresh)
    low, high = np.minimum.reduceat(ords[order], heads), np.maximum.reduceat(ords[order], heads)
    group = np.cumsum(fresh) - 1
    keep = (low != high)[group]
    order, group = order[keep], group[keep]
    if not len(order):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    # distinct contents, in the order of their groups; equal contents have equal groups and places
    known: dict[bytes, int] = {}
    content = np.array([known.setdefault(body[a:b], len(known)) for a, b in zip(begins[order].tolist(), ends[order].tolist())])
    contents = list(known)
    owner = np.full(len(contents), LAST)
    np.minimum.at(owner, content, ords[order])
    of_group, of_place = np.empty(len(contents), dtype=np.int64), np.empty(len(contents), dtype=np.int64)
    of_group[content], of_place[content] = group, place[order]
    sizes = np.array([len(c) for c in contents])
    windows = sizes - width + 1
    offsets = np.concatenate(([0], np.cumsum(windows)))
    least = np.repeat(owner, windows)
    _, group_at, per_group = np.unique(of_group, return_index=True, return_counts=True)
    by_group = np.argsort(group_at)
    pending: list[int] = []
    held = 0

    def flush() -> None:
        if pending:
            idx = np.array(pending)
            where = np.repeat(offsets[idx] - (np.cumsum(windows[idx]) - windows[idx]), windows[idx]) + np.arange(int(windows[idx].sum()))
            own = [contents[i] for i in pending]
            least[where] = _smallest(own, owner[idx], width) if held <= batch else _smallest_by_place(own, owner[idx], of_place[idx], width)

    for k in by_group.tolist():
        if per_group[k] > 1:
            own = range(int(group_at[k]), int(group_at[k] + per_group[k]))
            more = int(sizes[group_at[k] : group_at[k] + per_group[k]].sum()) + len(own)
            if pending and held + more > batch:
                flush()
                pending, held = [], 0
            pending += own
            held += more
    flush()
    n = windows[content]
    which = np.repeat(np.arange(len(order)), n)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    hit = least[offsets[content][which] + inside] < ords[order][which]
    edge = np.flatnonzero(hit)
    if not len(edge):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    new = np.ones(len(edge), dtype=bool)
    new[1:] = (np.diff(edge) != 1) | (which[edge][1:] != which[edge][:-1])
    a = edge[new]
    b = edge[np.append(np.flatnonzero(new)[1:] - 1, len(edge) - 1)]
    seg = order[which[a]]
    return ords[seg], marks[seg], start[seg] + inside[a], start[seg] + inside[b] + width


def _mark(raw: bytes) -> int:
    """What tells texts of one id, or of none, apart: a 64-bit hash."""
    mark = xxhash.xxh64_intdigest(raw, 42)
    return mark - (mark >> 63 << 64)


def _pieces(doc_id: int | None, text: str | None, width: int) -> list[tuple]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    mark, step = _mark(raw), SLICE - width
    starts = range(0, len(raw) - width + 1, step) if len(raw) > SLICE else (0,)
    return [(LAST if doc_id is None else doc_id, mark, at, raw[at : at + step + width - 1] if len(raw) > SLICE else raw) for at in starts]


def _covered_blob(covered: list[tuple[int, int, int, int]], turn: int) -> dict:
    c = np.array(covered, dtype=np.int64)
    return {"shard": -1 - turn % 4096, "docs": _packed(c[:, 0]), "marks": _packed(c[:, 1]), "doc": b"", "start": _packed(c[:, 2]), "length": _packed(c[:, 3]), "place": b"", "body": b""}


def _sliced(batches: Iterator[pa.RecordBatch], width: int, extra: str | None) -> Iterator[list[tuple]]:
    """Lists of pieces, each with the document's ``extra`` behind, of at most a slice."""
    held, pieces = 0, []
    for batch in batches:
        more = batch.column(extra).to_pylist() if extra else [None] * batch.num_rows
        for doc_id, text, x in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), more):
            for p in _pieces(doc_id, text, width):
                if held and held + len(p[3]) > SLICE:
                    yield pieces
                    held, pieces = 0, []
                pieces.append((*p, x))
                held += len(p[3])
    if pieces:
        yield pieces


def intervals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """ord, mark, start, end: covered bytes of the documents, in pieces that may overlap."""
    spark = docs.sparkSession
    session_limits(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    ask_shards, send_shards = max(-(-total // ASK_SHARD), cores), max(-(-total // SEND_SHARD), cores)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 64
        for pieces in _sliced(batches, width, None):
            part, turn = Slice(pieces, width), turn + 1
            rows = ask_slice(part, ask_shards)
            if part.covered:
                own = _covered_blob(part.covered, turn)
                rows.append({n: own[m] for n, m in zip(_ASK, ("shard", "docs", "marks", "doc", "start", "length"))})
            yield _blobs(rows, _ASK)

    def tell(group: pa.Table) -> pa.Table:
        parts = {c: group.column(c).to_pylist() for c in _ASK}
        if parts["shard"][0] < 0:
            cols = [np.concatenate([_unpacked(x, k).astype(np.int64) for x in parts[c]]) for c, k in (("docs", np.int64), ("marks", np.int64), ("number", np.int64), ("hash", np.int64))]
            return pa.table([pa.array(c, pa.int64()) for c in cols] + [pa.nulls(len(cols[0]), pa.binary())], names=["ord", "mark", "start", "end", "numbers"])
        o, m, n = shared_numbers(parts)
        none = pa.nulls(len(o), pa.int64())
        return pa.table([pa.array(o, pa.int64()), pa.array(m, pa.int64()), none, none, pa.array(n, pa.binary())], names=["ord", "mark", "start", "end", "numbers"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 64
        for pieces in _sliced(batches, width, "numbers"):
            part = Slice(pieces, width)
            wanted = [np.frombuffer(b"".join(p[4]), dtype=np.int64) if p[4] else None for p in part.pieces]
            covered, blobs = send_slice(part, wanted, send_shards)
            covered += part.covered
            turn += 1
            yield _blobs(blobs + ([_covered_blob(covered, turn)] if covered else []), _SEND)

    def answer(group: pa.Table) -> pa.Table:
        parts, rows = {n: group.column(n).to_pylist() for n in _SEND}, []
        for i in range(group.num_rows):
            n = _unpacked(parts["length"][i], np.int64 if parts["shard"][i] < 0 else np.int16).astype(np.int64)
            start = _unpacked(parts["start"][i], np.int64)
            if parts["shard"][i] < 0:
                rows.append((_unpacked(parts["docs"][i], np.int64), _unpacked(parts["marks"][i], np.int64), start, n))
            else:
                rows.append((*_owners(parts, i), start, n, _unpacked(parts["place"][i], np.uint8).astype(np.int64)))
        cols = [np.concatenate(c) for c in zip(*rows)]
        if parts["shard"][0] >= 0:
            cols = settle_shard(*cols, b"".join(zstandard.ZstdDecompressor().decompress(b) for b in parts["body"]), width)
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["ord", "mark", "start", "end"])

    asked = docs.select("doc_id", "text").mapInArrow(ask, _blob_sql(_ASK))
    told = written(asked.groupBy("shard").applyInArrow(tell, "ord long, mark long, start long, end long, numbers binary"), "numbers")
    wanted = told.where("numbers is not null").groupBy("ord", "mark").agg(F.collect_list("numbers").alias("numbers"))
    texts = _keyed(docs).join(wanted, ["ord", "mark"]).select("doc_id", "text", "numbers")
    sent = texts.mapInArrow(send, _blob_sql(_SEND))
    answers = sent.groupBy("shard").applyInArrow(answer, "ord long, mark long, start long, end long")
    return answers.unionByName(told.where("numbers is null").drop("numbers"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(int(LAST))).alias("ord"), F.xxhash64(text).alias("mark"))


def cut_out(raw: bytes, found: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the intervals, bytes removed, and maximal removed runs."""
    out, at, end, runs, removed = [], 0, -1, 0, 0
    for a, b in sorted(found):
        if a > end:
            out.append(raw[at:a])
            runs += 1
            removed += b - a
            at = end = b
        elif b > end:
            removed += b - end
            at = end = b
    return b"".join([*out, raw[at:]]), removed, runs


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, kept (binary), n_bytes, n_removed, n_spans of every document."""
    found = written(intervals(docs, width).groupBy("ord", "mark").agg(F.collect_set(F.struct("start", "end")).alias("found")), "intervals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            rows = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "found"))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                rows.append((doc_id, *cut_out(raw, [(s["start"], s["end"]) for s in spans or ()]), len(raw)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["doc_id", "kept", "n_removed", "n_spans", "n_bytes"])

    both = _keyed(docs).join(found, ["ord", "mark"], "left").select("doc_id", "text", "found")
    return both.mapInArrow(run, "doc_id long, kept binary, n_removed long, n_spans long, n_bytes long")


def op4_suffix(spark, sf_dir: str) -> DataFrame:
    kept = dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
