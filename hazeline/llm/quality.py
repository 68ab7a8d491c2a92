"""Quality classifier: weak labellers weighed by expectation-maximisation, then a hashed linear scorer.

Two questions are asked of every document: is it of good quality, and is it toxic. Some
heuristics vote on each, or abstain; where a labels table covers a document, its label is
one more voter. All documents' votes are counted by pattern (a few thousand at most), and
expectation-maximisation over the patterns estimates each voter's accuracy. The posterior
labels of all labelled documents (of all, without labels) train one sparse logistic scorer a question, over hashed
features: buckets of text statistics, words and word beginnings. All features that occur in
three of these documents take part: training works on a set of them, then a distributed pass sums the gradient of
every other one, and those at which a zero weight is not optimal join the set, until there
are none. The optimum of a sample is only where training begins; each later step is a
Newton step from gradients, curvatures and losses that a distributed pass sums over all; only how
features act on each other's slopes comes from the sample, which has no influence on where the
steps end. The scorers decide on every document: it is kept if quality is at least and
toxicity below one half.

Null texts count as empty: no votes, statistics of zero. Repeated rows are voted on and
scored alike. Documents without id can't be labelled or sampled. If a document has several
labels the worse one counts. Without any documents or labels the scorers rest on the
heuristics alone; without rows there are none out. Texts of any length are read in full. Patterns on
which as many voters say yes as no start expectation-maximisation at one half. Columns beside
doc_id and text are carried, not read; those named quality, toxic or keep give way.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discarded, session_limits, slices, table, written

FEATURES = 1 << 18
SAMPLE = 20_000  #: expected labelled documents at whose optimum training on all of them begins
SPARSITY = 5e-4  #: the L1 penalty on as many documents or more; on fewer it is larger, by the root of the ratio
TASKS = 64  #: tasks of a training pass, or twice the cores where these are more: what comes to the driver has a bound
MARKS = 1 << 23  #: bits that tell workers which documents may be labelled
WORKING = 2_000  #: features that join the working set at a time
LEAST_SEEN = 3  #: documents of the sample that a feature must occur in to have a weight
SLACK = 0.05  #: relative excess of a gradient over the penalty that counts as optimal
STEM = (4, 5, 6)
STILL = 2e-4  #: change of every weight in a step at which training ends
EXACT = 0.01  #: what the gradients of the weights in a set may be off by at the optimum over all, as a part of the penalty
JOINING = 200  #: weights of zero that may move in a step, those of most promise
ROUNDS = 60  #: passes of a training at most; a handful is usual
PIECE = 1 << 20  #: bytes of text whose words are hashed at once

DECORATED = re.compile(r"[*#$%&]{3}")
PUNCTUATION = b".,;:!?()[]{}\"'*#$%&|<>-_/\\"
STOP = frozenset("the of and to in is that it was for on are as with at by from or an be this which not have had der die das und ist von den mit zu auf für nicht ein eine im dem des sich als auch le la les de des et est un une que qui dans pour sur pas au aux du avec el los las y en es una por con para del se no lo su al".encode().split())
ENGLISH = frozenset(b"the of and to that it was for with by from be this which not".split())
INSULTS = frozenset(b"idiot idiots moron morons stupid dumb scum trash loser losers clown clowns worthless pathetic disgusting filthy vermin imbecile cretin pig pigs garbage hateful".split())


def plain_words(text: str) -> list[bytes]:
    return [w.strip(PUNCTUATION) for w in text.lower().encode("utf-8", "surrogatepass").split()]


def statistics(text: str, low: list[bytes] | None = None) -> tuple[float, ...]:
    """Shares of decorated words, shouts, table bars, repeated words, repeated lines, capitals, stop words; words and their mean length."""
    words = text.split()
    n = max(1, len(words))
    low = plain_words(text) if low is None else low
    lines = text.split("\n")
    same = sum(map(eq, low, islice(low, 1, None)))
    if same and b"" in low:
        same = sum(a == b for a, b in zip(low, low[1:]) if a)
    return (
        len(DECORATED.findall(text)) / n,
        text.count("!!") / n,
        text.count(" | ") / n,
        same / n,
        1 - len(set(lines)) / len(lines) if len(lines) >= 4 else 0.0,
        sum(len(w) > 1 for w in filter(str.isupper, words)) / n,
        sum(map(STOP.__contains__, low)) / n,
        float(len(words)),
        len(text) / n if words else 0.0,
    )


def quality_votes(s: tuple[float, ...]) -> list[int]:
    """+1 good, -1 bad, 0 abstain: each looks for one kind of junk; one for prose without any."""
    deco, bang, bars, same, lines, upper, stop, n, length = s
    bad = [deco > 0.06, bang > 0.06, bars > 0.06, same > 0.12, lines > 0.4, upper > 0.25]
    prose = 1 if stop > 0.12 and deco < 0.02 and bang < 0.02 and bars < 0.02 and same < 0.06 and lines < 0.2 else -1 if stop < 0.02 and n > 20 else 0
    return [-int(x) for x in bad] + [prose]


def toxic_votes(words: set[bytes]) -> list[int]:
    """+1 toxic, -1 not, 0 abstain. The list is English, so its silence counts in English alone."""
    hits = len(words & INSULTS)
    english = len(words & ENGLISH)
    return [int(hits > 0), int(hits > 1), -1 if english > 3 and not hits else 0]


def bucket_features(s: tuple[float, ...]) -> list[int]:
    edges = (0.005, 0.02, 0.04, 0.06, 0.1, 0.2, 0.4, 0.7)
    names = [f"s{i}:{sum(x > e for e in edges)}" for i, x in enumerate(s[:7])]
    names += [f"n:{min(12, int(s[7]).bit_length())}", f"l:{min(20, int(s[8]))}"]
    return [xxhash.xxh32_intdigest(x) % FEATURES for x in names]


P1, P2, P3, P4, P5 = (np.array([x], dtype=np.uint32) for x in (2654435761, 2246822519, 3266489917, 668265263, 374761393))
BLANK = 32
#: Bytes with A-Z lower-cased and all white space as blanks; which bytes are part of a word's core.
LOWERED = bytes(BLANK if bytes([x]).isspace() else bytes([x]).lower()[0] for x in range(256))
CORE = np.array([x != BLANK and x not in PUNCTUATION for x in LOWERED])


def _four(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = h + x * P3
    return ((h << np.uint32(17)) | (h >> np.uint32(15))) * P4


def _one(h: np.ndarray, x: np.ndarray | int) -> np.ndarray:
    h = h + x * P5
    return ((h << np.uint32(11)) | (h >> np.uint32(21))) * P1


def _feature(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * P2
    h = (h ^ (h >> np.uint32(13))) * P3
    return (h ^ (h >> np.uint32(16))).astype(np.int64) % FEATURES


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and features of the words in ``text`` (lower-cased, ending in blanks), stripped of punctuation.

    A word's features are XXH32 of "w:" and the word, and of "p:" and its first 4, 5 and 6
    bytes if it has as many.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    core = np.flatnonzero(CORE[raw])
    word = np.cumsum(raw == BLANK, dtype=np.int32)[core]
    fresh = np.flatnonzero(np.diff(word, prepend=-1))
    start = core[fresh]
    n = core[np.append(fresh[1:], len(core))[: len(fresh)] - 1] - start + 1
    two = np.ndarray(max(0, len(raw) - 1), "<u2", text, strides=(1,))
    four = np.ndarray(max(0, len(raw) - 3), "<u4", text, strides=(1,))
    at = lambda i, k: raw[i + k].astype(np.uint32)
    begin = two[start].astype(np.uint32) << np.uint32(16)

    h = P5 + (n + 2).astype(np.uint32)
    single = n == 1
    h = np.where(single, _one(_one(_one(h, np.uint32(ord("w"))), np.uint32(ord(":"))), at(start, 0)), _four(h, begin | np.uint32(0x3A77)))
    rest = np.where(single, 0, n - 2)
    for k in (0, 4):
        go = np.flatnonzero(rest >= k + 4)
        h[go] = _four(h[go], four[start[go] + 2 + k])
    tail = start + 2 + (rest & ~3)
    for k in range(3):
        go = np.flatnonzero((rest & 3) > k)
        h[go] = _one(h[go], at(tail[go], k))
    whole = _feature(h)
    for i in np.flatnonzero(n > 13).tolist():  # XXH32 takes 16 bytes and more in another way
        whole[i] = xxhash.xxh32_intdigest(b"w:" + text[start[i] : start[i] + n[i]]) % FEATURES

    places, found = [start], [whole]
    for k in STEM:
        own = np.flatnonzero(n >= k)
        s = start[own]
        h = _four(P5 + np.uint32(k + 2), begin[own] | np.uint32(0x3A70))
        if k == 6:
            h = _four(h, four[s + 2])
        else:
            for j in range(2, k):
                h = _one(h, at(s, j))
        places.append(s)
        found.append(_feature(h))
    return np.concatenate(places), np.concatenate(found)


def feature_keys(texts: list[str], stats: list[tuple[float, ...]], used: np.ndarray | None = None) -> np.ndarray:
    """number * FEATURES + feature of all features (of those ``used``) that a text has, in order, each once."""
    own = [i * FEATURES + f for i, s in enumerate(stats) for f in bucket_features(s) if used is None or used[f]]
    keys = [np.array(own, dtype=np.int64)]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    joined, at = b" ".join([*raw, b"    "]).translate(LOWERED), 0
    del raw
    while at < len(joined):
        cut = joined.find(b" ", at + PIECE)
        cut = len(joined) if cut < 0 else cut + 1
        places, f = hashed_words(joined[at:cut] + b"    ")
        if used is not None:
            places, f = places[used[f]], f[used[f]]
        keys.append(_distinct(np.searchsorted(ends, places + at, side="right") * FEATURES + f))
        at = cut
    return _distinct(np.concatenate(keys))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.diff(keys, prepend=-1) != 0]


def packed(keys: np.ndarray, n: int) -> pa.Array:
    """The features in ``keys`` of each of ``n`` rows as bytes: the gaps between them, seven bits a byte, the last byte below 128."""
    row = keys // FEATURES
    gap = np.diff(keys, prepend=0)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    gap[first] = keys[first] % FEATURES
    size = 1 + (gap >= 1 << 7) + (gap >= 1 << 14)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for k in range(3):
        go = np.flatnonzero(size > k)
        out[at[go] + k] = (gap[go] >> 7 * k & 127) | np.where(size[go] > k + 1, 128, 0)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, weights=size, minlength=n)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all rows, and their number in each, of lists or of what ``packed`` gave."""
    if not pa.types.is_binary(column.type):
        return column.flatten().to_numpy().astype(np.int64), pc.list_value_length(column).to_numpy().astype(np.int64)
    if not len(column):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
    gap = (raw[starts] & 127).astype(np.int64)
    for k in (1, 2):
        go = np.flatnonzero(ends - starts >= k)
        gap[go] |= (raw[starts[go] + k] & 127).astype(np.int64) << 7 * k
    bounds = np.searchsorted(ends, offsets - offsets[0])
    n, total = np.diff(bounds), np.concatenate(([0], np.cumsum(gap)))
    return total[1:] - np.repeat(total[bounds[:-1]], n), n


def encode_votes(votes: list[int]) -> int:
    return sum((v + 1) * 3**i for i, v in enumerate(votes))


def agree(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 for each vote pattern, and each voter's accuracy where it votes.

    patterns: rows of votes in -1, 0, 1; voters are independent given the class.
    """
    p = 1 / (1 + np.exp(-1.5 * patterns.sum(axis=1)))
    if not len(patterns):
        return p, np.zeros(0)
    for _ in range(rounds):
        before = p
        logit = np.log((counts @ p + 1) / (counts @ (1 - p) + 1))
        score = np.full(len(patterns), logit)
        right = np.zeros(patterns.shape[1])
        for j in range(patterns.shape[1]):
            for v in (-1, 0, 1):
                own = patterns[:, j] == v
                # a voter is taken to be right more often than not
                a = (counts[own] @ p[own] + 1 + 2 * (v == 1)) / (counts @ p + 5)
                b = (counts[own] @ (1 - p[own]) + 1 + 2 * (v == -1)) / (counts @ (1 - p) + 5)
                score[own] += np.log(a / b)
                right[j] += counts[own] @ (p[own] if v == 1 else 1 - p[own] if v == -1 else 0 * p[own])
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(p - before).max() < 1e-9:
            break
    voted = np.abs(patterns).T @ counts
    return p, right / np.maximum(1, voted)


def class_weights(target: np.ndarray, above: float, below: float) -> np.ndarray:
    """Weights of rows such that either class, of ``above`` and ``below`` rows, weighs one half."""
    return np.where(target > 0.5, 0.5 / max(1.0, above), 0.5 / max(1.0, below))


def train(rows: list[np.ndarray], target: np.ndarray, n: int, sparsity: float = SPARSITY, steps: int = 300, start: tuple[np.ndarray, float] | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer on soft labels, by accelerated proximal gradient with an L1 penalty.

    The plain form of what ``fit`` finds, to hold it against.
    """
    w, bias = (np.zeros(n), 0.0) if start is None else start
    if not rows:
        return w, bias
    sizes = np.array([len(r) for r in rows])
    cols = np.concatenate(rows).astype(np.int64)
    starts, some = np.cumsum(sizes) - sizes, sizes > 0
    weight = class_weights(target, (target > 0.5).sum(), (target <= 0.5).sum())
    # a bound of the curvature along each feature: rare ones may move far
    rate = 4.0 / np.maximum(1e-6, np.bincount(cols, weights=np.repeat(weight * (sizes + 1), sizes), minlength=n))
    rate_bias = 4.0 / float((weight * (sizes + 1)).sum())
    y, y_bias, t = w.copy(), bias, 1.0
    for _ in range(steps):
        z = np.full(len(rows), y_bias)
        if len(cols):
            z[some] += np.add.reduceat(y[cols], starts[some])
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        grad = np.bincount(cols, weights=np.repeat(off, sizes), minlength=n)
        new = y - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * sparsity, 0)
        new_bias = y_bias - rate_bias * off.sum()
        if ((new - w) * (y - new)).sum() + (new_bias - bias) * (y_bias - new_bias) > 0:
            t = 1.0  # momentum leads uphill: begin anew
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, y_bias = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        moved = max(float(np.abs(new - w).max(initial=0.0)), abs(new_bias - bias))
        w, bias, t = new, new_bias, t_new
        if moved < STILL:
            break
    return w, bias


SUMS = 2.0**48  #: as POINT, for sums that may be larger
POINT = 2.0**50  #: gradients are summed as whole multiples of its inverse, in which order has no influence


def gradients(sample: DataFrame, weights: np.ndarray, biases: np.ndarray, sizes: list[tuple[float, float]]) -> DataFrame:
    """f, q, t: the gradient of both questions' loss by the weight of every feature that occurs in enough documents.

    sizes: rows of the upper and the lower class of each question.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, FEATURES)), np.zeros(FEATURES, dtype=np.int64)
        for batch in batches:
            flat, n = unpacked(batch.column("features"))
            some, starts = n > 0, np.cumsum(n) - n
            seen += np.bincount(flat, minlength=FEATURES)
            for i, name in enumerate(("p_q_all", "p_t_all")):
                target = batch.column(name).to_numpy()
                z = np.full(len(n), biases[i])
                if len(flat):
                    z[some] += np.add.reduceat(weights[i][flat], starts[some])
                off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * class_weights(target, *sizes[i])
                total[i] += np.bincount(flat, weights=np.repeat(off, n), minlength=FEATURES)
        f = np.flatnonzero(seen)
        whole = np.rint(total[:, f] * POINT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(whole[0]), pa.array(whole[1]), pa.array(seen[f])], names=["f", "q", "t", "n"])

    parts = _few(sample).mapInArrow(run, "f int, q long, t long, n long")
    return parts.groupBy("f").agg(*[(F.sum(c) / POINT).alias(c) for c in ("q", "t")], F.sum("n").alias("n")).where(F.col("n") >= LEAST_SEEN)


def _few(rows: DataFrame) -> DataFrame:
    """``rows`` in as many tasks as a training pass may have."""
    return rows.coalesce(max(TASKS, 2 * rows.sparkSession.sparkContext.defaultParallelism))


def summed(batches: Iterable[pa.RecordBatch], weights: np.ndarray, biases: np.ndarray, sizes: list[tuple[float, float]]) -> np.ndarray:
    """Gradients and curvatures, (2, features + 1) each, of both questions' loss by the weights and, last, by the bias, and both losses; as whole multiples."""
    width = weights.shape[1]
    total, loss = np.zeros((2, 2, width + 1)), np.zeros(2)
    for batch in batches:
        flat, n = unpacked(batch.column("features"))
        some, starts = n > 0, np.cumsum(n) - n
        for i, name in enumerate(("p_q_all", "p_t_all")):
            target = batch.column(name).to_numpy()
            z = np.full(len(n), biases[i])
            if len(flat):
                z[some] += np.add.reduceat(weights[i][flat], starts[some])
            weight, p = class_weights(target, *sizes[i]), 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            loss[i] += (weight * (np.logaddexp(0, z) - target * z)).sum()
            for k, off in enumerate(((p - target) * weight, p * (1 - p) * weight)):
                total[k, i, :-1] += np.bincount(flat, weights=np.repeat(off, n), minlength=width)
                total[k, i, -1] += off.sum()
    return np.rint(np.concatenate((total.ravel(), loss)) * SUMS).astype(np.int64)


def summed_over(rows: DataFrame, weights: np.ndarray, biases: np.ndarray, sizes: list[tuple[float, float]]) -> np.ndarray:
    """As ``summed``, by a pass over ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([summed(batches, weights, biases, sizes).tobytes()], pa.binary())], names=["part"])

    parts = _few(rows).mapInArrow(run, "part binary").collect()
    return sum((np.frombuffer(r.part, dtype=np.int64) for r in parts), np.zeros(4 * (weights.shape[1] + 1) + 2, dtype=np.int64))


def crossed(near: list[pa.RecordBatch], name: str, w: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Curvature of the loss of question ``name`` over ``near`` at ``w`` between the ``wanted`` features and, last, the bias."""
    k = len(wanted) + 1
    place = np.full(len(w) - 1, -1, dtype=np.int64)
    place[wanted] = np.arange(k - 1)
    above = sum(int((b.column(name).to_numpy() > 0.5).sum()) for b in near)
    below, out = sum(len(b) for b in near) - above, np.zeros((k, k))
    for batch in near:
        flat, n = unpacked(batch.column("features"))
        row, col = np.repeat(np.arange(len(n)), n), place[flat]
        p = 1 / (1 + np.exp(-np.clip(w[-1] + np.bincount(row, weights=w[flat], minlength=len(n)), -30, 30)))
        weight = class_weights(batch.column(name).to_numpy(), above, below) * p * (1 - p)
        dense = np.zeros((len(n), k))
        dense[row[col >= 0], col[col >= 0]] = 1
        dense[:, -1] = 1
        dense *= np.sqrt(weight[:, None])
        out += dense.T @ dense
    return out


def stepped(curve: np.ndarray, slope: np.ndarray, w: np.ndarray, sparsity: float, sweeps: int = 400) -> np.ndarray:
    """The minimum of a quadratic about ``w`` with an L1 penalty on all but the last weight.

    By coordinate descent; where its signs are those of the minimum, a linear system ends it.
    """
    at, moved_slope = w.astype(float), slope.astype(float).copy()
    steep, last, live = curve.diagonal().tolist(), len(w) - 1, range(len(w))
    for sweep in range(sweeps):
        most, full = 0.0, sweep % 8 == 0
        for j in range(len(w)) if full else live:
            old = float(at[j])
            u, limit = steep[j] * old - float(moved_slope[j]), 0.0 if j == last else sparsity
            new = (u - limit if u > limit else u + limit if u < -limit else 0.0) / steep[j]
            if (by := new - old) != 0:
                at[j] = new
                moved_slope += by * curve[j]
                most = max(most, abs(by))
        if full and most < STILL / 100:
            break
        live = [j for j in range(len(w)) if at[j] != 0 or j == last]
        if full:
            signs = np.append(np.sign(at[live[:-1]]), 0.0)
            by = np.linalg.lstsq(curve[np.ix_(live, live)], -(moved_slope[live] + sparsity * signs), rcond=None)[0]
            if (np.sign(at[live] + by)[:-1] == signs[:-1]).all():
                at[live] += by
                moved_slope += by @ curve[live]
    return at


def train_over(sums: Callable, near: list[pa.RecordBatch], sets: list[np.ndarray], sparsity: float, start: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The optimum of ``train`` for both questions; weights outside a question's set stay zero.

    sums: gradients, curvatures and losses over all rows at given weights; near: some of the
    rows. Steps minimise a quadratic: its slopes and the curvatures of single weights are
    those of all rows, the curvatures between weights those of ``near``. A step that does not
    lessen the loss over all rows is taken back, and the next one from there is shorter.
    """
    w = np.concatenate((start[0], start[1][:, None]), axis=1)
    width = w.shape[1]
    free = [np.append(np.isin(np.arange(width - 1), own), True) for own in sets]
    # per question: the best point's loss, gradients and curvatures; and how much shorter steps are
    best: list[tuple | None] = [None, None]
    held, live, tried = [0.01, 0.01], [True, True], w.copy()
    for _ in range(ROUNDS):
        found = sums(tried[:, :-1], tried[:, -1]) / SUMS
        (grads, bends), losses = found[:-2].reshape(2, 2, width), found[-2:]
        for i in np.flatnonzero(live):
            value = losses[i] + sparsity * np.abs(tried[i, :-1]).sum()
            moved = np.abs(tried[i] - w[i]).max()
            if best[i] is None or value <= best[i][0]:
                w[i], best[i], held[i] = tried[i], (value, grads[i], bends[i]), max(1e-4, held[i] / 8)
                g = grads[i]
                off = np.where(w[i] != 0, np.abs(g + sparsity * np.sign(w[i])), np.maximum(0, np.abs(g) - sparsity))
                off[-1] = abs(g[-1])
                live[i] = off[free[i]].max() > EXACT * sparsity
            else:
                held[i] *= 16
                live[i] = moved >= STILL / 100
            if not live[i]:
                tried[i] = w[i]
                continue
            _, g, bend = best[i]
            gain = np.where(free[i] & (w[i] == 0), np.maximum(0, np.abs(g) - sparsity) ** 2 / np.maximum(1e-9, bend), 0.0)[:-1]
            own = np.sort(np.concatenate((np.flatnonzero(w[i, :-1]), [j for j in np.argsort(-gain, kind="stable")[:JOINING] if gain[j] > 0]))).astype(np.int64)
            curve, wide = crossed(near, ("p_q_all", "p_t_all")[i], w[i], own), np.append(own, width - 1)
            np.fill_diagonal(curve, np.maximum(1e-9, np.maximum(curve.diagonal(), bend[wide]) + held[i] * bend[wide]))
            tried[i] = w[i]
            tried[i, wide] = stepped(curve, g[wide], w[i, wide], sparsity)
        if not any(live):
            break
    return w[:, :-1], w[:, -1]


def fit(sample: DataFrame, sparsity: float = SPARSITY, working: int = WORKING, start: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (2, FEATURES) and biases of both scorers over all features of ``sample`` (features, p_q_all, p_t_all).

    A working set grows until no feature outside it has a gradient beyond the penalty: the
    optimum over the set is then that over all features. With ``start``, weights and biases
    to begin from, training passes over the rows, and the driver sees some ``SAMPLE`` of them.
    """
    weights, biases = (np.zeros((2, FEATURES)), np.zeros(2)) if start is None else (start[0].copy(), start[1].copy())
    counts = sample.agg(F.count("*"), F.count_if(F.col("p_q_all") > 0.5), F.count_if(F.col("p_t_all") > 0.5)).first()
    if not counts[0]:
        return weights, biases
    sizes = [(counts[i], counts[0] - counts[i]) for i in (1, 2)]
    sets = [np.flatnonzero(w) for w in weights]
    fresh, rows = start is not None, None
    share = F.pmod(F.xxhash64("features", "p_q_all", "p_t_all"), F.lit(1 << 20)) < max(1, int(SAMPLE / counts[0] * 2**20))
    while True:
        grown = []
        slopes = gradients(sample, weights, biases, sizes)
        beyond = slopes.where((F.abs("q") > sparsity * (1 + SLACK)) | (F.abs("t") > sparsity * (1 + SLACK))).toPandas()
        for i, c in enumerate(("q", "t")):
            own = beyond[(beyond[c].abs() > sparsity * (1 + SLACK)) & ~beyond["f"].isin(sets[i])]
            best = own["f"].to_numpy()[np.lexsort((own["f"], -own[c].abs()))[:working]].astype(np.int64)
            grown.append(len(best) > 0)
            sets[i] = np.union1d(sets[i], best)
        if not any(grown) and not fresh:
            if rows is not None:
                discarded(rows)
            return weights, biases
        fresh, names = False, np.union1d(*sets)
        seen = sample if start is None else sample.where(share).limit(2 * SAMPLE)
        near = _only(seen, names).toArrow().combine_chunks().to_batches(max_chunksize=1000)
        if start is None:
            sums = lambda w, b: summed(near, w, b, sizes)
        else:
            rows = written(_only(sample, names), "working", rows)
            sums = lambda w, b: summed_over(rows, w, b, sizes)
        at = [np.searchsorted(names, own) for own in sets]
        weights[:, names], biases = train_over(sums, near, at, sparsity, (weights[:, names], biases))


class Scorer:
    """Weights of both questions over the hashed features."""

    def __init__(self, weights: np.ndarray, biases: np.ndarray):
        self.weights, self.biases = weights, biases  # (2, FEATURES), (2,)
        self.used = (weights != 0).any(axis=0)

    def batch(self, texts: list[str]) -> np.ndarray:
        """Probabilities (documents, 2) of good quality and of toxicity."""
        keys = feature_keys(texts, [statistics(t) for t in texts], self.used)
        z = [b + np.bincount(keys // FEATURES, weights=w[keys % FEATURES], minlength=len(texts)) for w, b in zip(self.weights, self.biases)]
        return 1 / (1 + np.exp(-np.clip(np.stack(z, axis=1), -30, 30)))


def voted(docs: DataFrame, marks: np.ndarray | None) -> DataFrame:
    """doc_id, votes of both questions as codes, and packed features of the documents whose id may be marked, of all without ``marks``."""
    session_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 6 << 20):
            q, t, texts, stats, held = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                low = plain_words(text)
                s = statistics(text, low)
                q.append(encode_votes(quality_votes(s)))
                t.append(encode_votes(toxic_votes(set(low))))
                held.append(doc_id is not None and (marks is None or bool(marks[(at := _mark(doc_id)) >> 3] >> (at & 7) & 1)))
                if held[-1]:
                    texts.append(text)
                    stats.append(s)
            own = packed(feature_keys(texts, stats), len(texts))
            features = own.take(pa.array(np.where(held, np.cumsum(held) - 1, 0), pa.int64(), mask=~np.array(held, dtype=bool)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(q, pa.int32()), pa.array(t, pa.int32()), features], names=["doc_id", "q", "t", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, q int, t int, features binary")


def _mark(doc_id: int) -> int:
    return xxhash.xxh32_intdigest(str(doc_id)) % MARKS


def marks_of(gold: DataFrame) -> np.ndarray:
    """A bit for every mark of an id of ``gold``: ids without it are not there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_mark(i) for i in batch.column("doc_id").to_pylist()], pa.int32())], names=["mark"])

    bits = np.zeros(MARKS, dtype=bool)
    bits[gold.select("doc_id").mapInArrow(run, "mark int").distinct().toArrow().column("mark").to_numpy()] = True
    return np.packbits(bits, bitorder="little")


N_QUALITY, N_TOXIC = 7, 3


def learn(docs: DataFrame, labels: DataFrame | None) -> tuple[Scorer, dict[str, list[float]]]:
    """The scorers, and the voters' accuracies that expectation-maximisation found."""
    spark = docs.sparkSession
    if labels is None:
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    gold = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    n_gold = gold.count()
    votes = written(voted(docs, marks_of(gold) if n_gold else None), "votes")
    as_vote = lambda c: F.coalesce(F.when(F.col(c) == 1, 2).when(F.col(c) == 0, 0), F.lit(1))
    codes = {"q_all": as_vote("quality") * 3**N_QUALITY + F.col("q"), "t_all": as_vote("toxic") * 3**N_TOXIC + F.col("t")}
    rows = votes.join(gold, "doc_id", "left").withColumns(codes)
    posterior, accuracy = {}, {}
    for name, column, n in (("quality", "q_all", N_QUALITY + 1), ("toxic", "t_all", N_TOXIC + 1)):
        seen = rows.groupBy(column).count().collect()
        codes, counts = [r[0] for r in seen], np.array([r[1] for r in seen], dtype=float)
        patterns = np.array([[c // 3**i % 3 - 1 for i in range(n)] for c in codes]).reshape(-1, n)
        p, right = agree(patterns, counts)
        posterior[column], accuracy[name] = dict(zip(codes, p.tolist())), right.tolist()
    sample = rows.where("features is not null")
    if n_gold:
        sample = sample.where("quality is not null")
    for column in ("q_all", "t_all"):
        known = spark.createDataFrame([(int(c), float(p)) for c, p in posterior[column].items()], f"{column} int, p_{column} double")
        sample = sample.join(F.broadcast(known), column)  # as many rows as vote patterns
    whole = written(sample.select("features", "p_q_all", "p_t_all", F.xxhash64("doc_id").alias("spot")), "sample", votes)
    n, columns = whole.count(), ["features", "p_q_all", "p_t_all"]
    sparsity = SPARSITY * max(1.0, SAMPLE / max(1, n)) ** 0.5
    weights, biases = fit(whole.where(F.pmod("spot", F.lit(1 << 20)) < max(1, int(SAMPLE / max(1, n) * 2**20))).select(columns), sparsity)
    if n > SAMPLE:
        weights, biases = fit(whole.select(columns), sparsity, start=(weights, biases))
    discarded(whole)
    return Scorer(weights, biases), accuracy


def _only(sample: DataFrame, names: np.ndarray) -> DataFrame:
    """``sample`` with the places in the sorted ``names`` as features, packed, and no other features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(FEATURES, -1, dtype=np.int64)
        place[names] = np.arange(len(names))
        for batch in batches:
            flat, n = unpacked(batch.column("features"))
            at = place[flat]
            keys = (np.repeat(np.arange(len(n)), n) * FEATURES + at)[at >= 0]
            yield pa.RecordBatch.from_arrays([packed(keys, len(n)), batch.column("p_q_all"), batch.column("p_t_all")], names=["features", "p_q_all", "p_t_all"])

    return sample.mapInArrow(run, "features binary, p_q_all double, p_t_all double")


def judged(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``docs`` with quality, toxic (probabilities) and keep."""
    scorer, _ = learn(docs, labels)
    docs = docs.drop("quality", "toxic", "keep")
    columns = docs.columns
    schema = docs.withColumns({"quality": F.lit(0.0), "toxic": F.lit(0.0), "keep": F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            p = scorer.batch([t or "" for t in batch.column("text").to_pylist()])
            cols = [*(batch.column(c) for c in columns), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array((p[:, 0] >= 0.5) & (p[:, 1] < 0.5))]
            yield pa.RecordBatch.from_arrays(cols, names=[*columns, "quality", "toxic", "keep"])

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of ``docs`` that the scorers keep, with all their columns."""
    scorer, _ = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            p = scorer.batch([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array((p[:, 0] >= 0.5) & (p[:, 1] < 0.5)))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "labels")).drop("text")
