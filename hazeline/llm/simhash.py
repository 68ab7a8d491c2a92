"""SimHash near-duplicate grouping by tiled exact comparison.

Every document gets a fingerprint of one or more 64-bit words: a bit is 1 where
more than half of the document's word shingles have it set in their hash. The
*distinct* fingerprints are then compared exactly. They are split into blocks of
one class each (for the plain operator the class is the population count); two
blocks meet only where their classes can hold fingerprints within the radius, and
inside a block pair, tiles whose part-wise population counts differ by more than
the radius are skipped. Each block pair returns a spanning forest of its links,
never all pairs, and star contraction joins the forests into components.
The pipeline's stage takes these as rough groups and checks the shingle sets inside each.

Null texts count as empty. Texts without words have fingerprint zero and link
like any other. Rows without ``doc_id`` take part; they are ignored when the
smallest id of a component is taken (a component of only such rows gets null).
Repeated rows share a fingerprint and a component. Extra columns are not read, and the
pipeline's stage carries them whatever their names. Texts of any length are hashed in
full, a batch of bounded bytes at a time; a table without rows gives one without rows.
Shingle sets are told apart by 64 bits of hash: two of 10^9 sets clash with odds of 0.03.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_columns, session_limits, slices, table, written

BLOCK = 131_072  #: fingerprints in a block; a task holds two blocks
TILE = 256  #: fingerprints in a tile
#: Share of the bits in which pairs that are checked on their shingles may differ. At Jaccard 0.8 it is 0.15
#: on average, 0.19 at most (4 shingles of 5), and 0.3 lies more than four deviations above.
CANDIDATES = 0.3
MEMBERS = 2_000_000  #: shingles of a group that meet in one task


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at ASCII white space and nowhere else."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_spans(words: list[bytes], width: int) -> tuple[bytes, list[int], list[int]]:
    """The space-joined words, and where each shingle begins and ends there."""
    joined = b" ".join(words)
    if not words:
        return joined, [], []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < width:
        return joined, [0], [len(joined)]
    return joined, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()


def majority(hashes: np.ndarray) -> int:
    """One word: bit b is 1 if set in more than half of ``hashes``."""
    n, ones = len(hashes), np.zeros(64, dtype=np.int64)
    for at in range(0, n, 255 * 64):
        part = hashes[at : at + 255 * 64]
        if len(part) % 255:
            part = np.concatenate((part, np.zeros(-len(part) % 255, dtype=np.uint64)))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 255, 8), axis=2, bitorder="little")
        ones += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, width: int = 4, n_words: int = 1) -> tuple[list[int], int]:
    """Fingerprint words of one text, and its number of shingles.

    One word is built from XXH64 with seed 42; more words, two at a time, from 128-bit XXH3.
    """
    joined, starts, ends = shingle_spans(words_of(text), width)
    if not starts:
        return [0] * n_words, 0
    shingles, out = [joined[a:b] for a, b in zip(starts, ends)], []
    if n_words == 1:
        digest = xxhash.xxh64_digest
        return [majority(np.frombuffer(b"".join([digest(s, 42) for s in shingles]), dtype=">u8").astype(np.uint64))], len(starts)
    digest = xxhash.xxh3_128_digest
    for seed in range(42, 42 + n_words // 2):
        halves = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        out += [majority(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
    return out, len(starts)


def fingerprints(docs: DataFrame, width: int = 4, n_words: int = 1) -> DataFrame:
    """Columns of ``docs`` but ``text``, and ``f0``.., ``n_shingles`` of its text."""
    session_limits(docs.sparkSession)
    keep = [c for c in docs.columns if c != "text"]
    names = [f"f{i}" for i in range(n_words)]
    schema = docs.select(keep).withColumns({c: F.lit(0).cast("long") for c in [*names, "n_shingles"]}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            rows = [fingerprint(t, width, n_words) for t in batch.column("text").to_pylist()]
            cols = [pa.array(np.array([r[0][i] for r in rows], dtype=np.uint64).view(np.int64)) for i in range(n_words)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols, pa.array([r[1] for r in rows], pa.int64())], names=[*keep, *names, "n_shingles"])

    return docs.mapInArrow(run, schema)


class Forest:
    """Union-find over positions 0..n-1 that remembers which links joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        roots = self.up
        while not np.array_equal(nxt := roots[roots], roots):
            roots = nxt
        self.up = roots.copy()
        new = roots[a] != roots[b]
        for x, y in zip(a[new].tolist(), b[new].tolist()):
            if (p := self.find(x)) != (q := self.find(y)):
                self.up[max(p, q)] = min(p, q)
                self.links.append((x, y))


def _parts(words: np.ndarray) -> np.ndarray:
    """Population counts of the 16-bit parts of every fingerprint's first word."""
    return np.bitwise_count(np.ascontiguousarray(words[:, 0]).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def link_blocks(words: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, sizes: np.ndarray | None = None, least: float = 0.0, tile: int = TILE) -> list[tuple[int, int]]:
    """A spanning forest of the links between positions ``left`` and ``right``.

    words: one row of 64-bit words a fingerprint. sizes, least: a link also needs
    min(size) >= least * max(size).
    """
    parts = _parts(words)

    def tiled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = parts[rows]
        rows = rows[np.lexsort((p[:, 3], p[:, 2], p[:, 1], p[:, 0]))]
        at, p = np.arange(0, len(rows), tile), parts[rows]
        return rows, np.minimum.reduceat(p, at), np.maximum.reduceat(p, at)

    forest = Forest(len(words))
    if not len(left) or not len(right):
        return []
    a, lo_a, hi_a = tiled(left)
    b, lo_b, hi_b = tiled(right)
    for i in range(len(lo_a)):
        apart = np.maximum(0, np.maximum(lo_b - hi_a[i], lo_a[i] - hi_b)).sum(axis=1)
        rows = a[i * tile : (i + 1) * tile]
        for j in np.flatnonzero(apart <= radius).tolist():
            cols = b[j * tile : (j + 1) * tile]
            # the sum is within the radius only if some word is within its share of it
            near = np.zeros((len(rows), len(cols)), dtype=bool)
            for w in range(words.shape[1]):
                near |= np.bitwise_count(words[rows, w][:, None] ^ words[cols, w][None, :]) <= radius // words.shape[1]
            x, y = np.nonzero(near)
            x, y = rows[x], cols[y]
            ok = x != y
            if words.shape[1] > 1:
                ok &= np.bitwise_count(words[x] ^ words[y]).sum(axis=1) <= radius
            if sizes is not None:
                ok &= np.minimum(sizes[x], sizes[y]) >= least * np.maximum(sizes[x], sizes[y])
            if ok.any():
                forest.add(x[ok], y[ok])
    return forest.links


def links(nodes: DataFrame, n_words: int, radius: int, reach: int, least: float = 0.0, block: int = BLOCK) -> DataFrame:
    """Forest edges ``(a, b)`` between ``nodes`` (node, f0.., n_shingles, cls).

    cls is the class that decides which blocks meet: those at most ``reach`` apart.
    The histogram of classes is all that comes to the driver; population counts
    and logarithms of lengths have fewer than a hundred values.
    """
    spark = nodes.sparkSession
    counts = {r[0]: r[1] for r in nodes.groupBy("cls").count().collect()}
    splits = {c: -(-n // block) for c, n in counts.items()}
    n_pairs, first, total = 0, {}, 0.0
    for c in sorted(splits):
        for d in sorted(splits):
            if c <= d <= c + reach:
                first[c, d] = n_pairs
                n_pairs += splits[c] * splits[d]
                total += counts[c] * counts[d] / (1 + (c == d))
    if not n_pairs:
        return spark.createDataFrame([], "a long, b long")

    # member of (c, d): row block i of c meets every block of d; column block i of d meets every block of c
    def member(side: str) -> F.Column:
        branch = None
        for c in sorted(splits):
            seqs = []
            for d in sorted(splits):
                if side == "left" and c <= d <= c + reach:
                    at = F.lit(first[c, d]).cast("long") + F.col("blk") * splits[d]
                    seqs.append(F.sequence(at, at + (splits[d] - 1)))
                if side == "right" and d <= c <= d + reach:
                    at = F.lit(first[d, c]).cast("long") + F.col("blk")
                    seqs.append(F.sequence(at, at + splits[c] * (splits[d] - 1), F.lit(splits[c]).cast("long")))
            value = F.flatten(F.array(*seqs))
            branch = F.when(F.col("cls") == c, value) if branch is None else branch.when(F.col("cls") == c, value)
        return branch

    k = F.create_map(*[x for c, n in splits.items() for x in (F.lit(c), F.lit(n))])
    placed = nodes.withColumn("blk", F.pmod(F.xxhash64(F.lit(7), "node"), F.element_at(k, F.col("cls"))).cast("long"))
    names = [f"f{i}" for i in range(n_words)]
    sides = [placed.select(F.explode(member(s)).alias("pair"), F.lit(s == "left").alias("is_left"), "node", *names, "n_shingles") for s in ("left", "right")]
    tasks = int(min(n_pairs, max(2 * spark.sparkContext.defaultParallelism, total / 4e9, sum(counts.values()) / 1e5)))

    def run(group: pa.Table) -> pa.Table:
        left = group.column("is_left").to_numpy(zero_copy_only=False)
        node = group.column("node").to_numpy()
        words = np.stack([group.column(c).to_numpy().view(np.uint64) for c in names], axis=1)
        sizes = group.column("n_shingles").to_numpy()
        found = link_blocks(words, np.flatnonzero(left), np.flatnonzero(~left), radius, sizes if least else None, least)
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        a, b = node[ends[:, 0]], node[ends[:, 1]]
        return pa.table({"a": a[a != b], "b": b[a != b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return sides[0].unionByName(sides[1]).repartition(tasks, "pair").groupBy("pair").applyInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b), root the smallest node of its component.

    Large-star and small-star contraction; each round is written, so a lost
    executor costs one round. Minima are aggregated before the join, and AQE splits
    the join of a hub's edges.
    """
    both = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        ways = both.select("u", "v").union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = ways.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u <> v").distinct()
        both = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", both)
        now = both.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = both.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(both.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs`` (doc_id, text)."""
    prints = written(fingerprints(docs.select("doc_id", "text"), width).select("doc_id", "f0", "n_shingles"), "prints")
    distinct = written(prints.groupBy("f0").agg(F.min("doc_id").alias("least_id")), "distinct")
    nodes = distinct.select(F.col("f0").alias("node"), "f0", F.lit(0).cast("long").alias("n_shingles"), F.bit_count("f0").alias("cls"))
    roots = components(links(nodes, 1, radius, radius))
    placed = distinct.join(roots.withColumnRenamed("node", "f0"), "f0", "left").select("f0", "least_id", F.coalesce("root", "f0").alias("root"))
    best = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = placed.select("f0", "root").join(best, "root").select("f0", "component_id")
    digits = F.lower(F.lpad(F.hex("f0"), 16, "0"))
    return prints.join(ids, "f0").select("doc_id", digits.alias("fingerprint"), "component_id")


def set_fingerprint(text: str | None, width: int = 5, n_words: int = 4) -> tuple[list[int], np.ndarray]:
    """Fingerprint words of the *distinct* shingles of one text, and their sorted 64-bit hashes."""
    joined, starts, ends = shingle_spans(words_of(text), width)
    shingles = {joined[a:b] for a, b in zip(starts, ends)}
    if not shingles:
        return [0] * n_words, np.empty(0, dtype=np.uint64)
    out, digest = [], xxhash.xxh3_128_digest
    for seed in range(42, 42 + n_words // 2):
        halves = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        if seed == 42:
            hashes = np.sort(halves[:, 0])
        out += [majority(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
    return out, hashes


def shingle_sets(docs: DataFrame, width: int, n_words: int, with_hashes: bool) -> DataFrame:
    """Columns of ``docs`` but ``text``; ``node``, a hash of the text's shingle set; ``f0``.., ``n_shingles`` of the set, and ``hashes`` of its members if asked for."""
    session_limits(docs.sparkSession)
    keep = [c for c in docs.columns if c != "text"]
    names = ["node", *[f"f{i}" for i in range(n_words)], "n_shingles"]
    more = ["hashes"] if with_hashes else []
    schema = docs.select(keep).withColumns({c: F.lit(0).cast("long") for c in names} | {c: F.array(F.lit(0).cast("long")) for c in more}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20 if with_hashes else 16 << 20):
            rows = []
            for text in batch.column("text").to_pylist():
                words, hashes = set_fingerprint(text, width, n_words)
                rows.append(([xxhash.xxh3_64_intdigest(hashes.tobytes()), *words, len(hashes)], hashes.view(np.int64) if with_hashes else None))
            cols = [pa.array(c.view(np.int64)) for c in np.array([r[0] for r in rows], dtype=np.uint64).reshape(-1, len(names)).T.copy()]
            sets = [pa.array([r[1] for r in rows], pa.list_(pa.int64()))] if with_hashes else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols, *sets], names=[*keep, *names, *more])

    return docs.mapInArrow(run, schema)


def similar_links(words: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, radius: int, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of ``left`` and ``right`` whose sets have a Jaccard similarity of ``least`` or more.

    Pairs farther apart than ``radius`` bits are not looked at; the nearest come first, so
    that most pairs of a large group are joined already when their turn comes.
    """
    sizes, forest = np.array([len(x) for x in sets]), Forest(len(sets))
    for at in range(0, len(left), TILE):
        for to in range(0, len(right), TILE):
            rows, cols = left[at : at + TILE], right[to : to + TILE]
            apart = np.zeros((len(rows), len(cols)), dtype=np.int16)
            for w in range(words.shape[1]):
                apart += np.bitwise_count(words[rows, w][:, None] ^ words[cols, w][None, :])
            x, y = np.nonzero(apart <= radius)
            order = np.argsort(apart[x, y], kind="stable")
            x, y = rows[x[order]], cols[y[order]]
            fit = (x != y) & (np.minimum(sizes[x], sizes[y]) >= least * np.maximum(sizes[x], sizes[y]))
            for i, j in zip(x[fit].tolist(), y[fit].tolist()):
                if (p := forest.find(i)) != (q := forest.find(j)):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both >= least * (len(sets[i]) + len(sets[j]) - both):
                        forest.up[max(p, q)] = min(p, q)
                        forest.links.append((i, j))
    return forest.links


def confirmed(members: DataFrame, n_words: int, radius: int, least: float, most: int = MEMBERS) -> DataFrame:
    """Forest edges ``(a, b)`` of the pairs of one ``group`` whose shingle sets are similar.

    members: group, node, f0.., n_shingles, hashes, one row a node. A group of more than
    ``most`` shingles is dealt into parts, and every two parts meet in a task of their own.
    """
    sums = members.groupBy("group").agg(F.sum("n_shingles").alias("all"))
    parts = F.ceil(F.greatest(F.col("all"), F.lit(1)) / most).cast("int")
    placed = members.join(sums.select("group", parts.alias("parts")), "group").withColumn("part", F.pmod(F.xxhash64(F.lit(11), "node"), "parts").cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    names = [f"f{i}" for i in range(n_words)]

    def run(group: pa.Table) -> pa.Table:
        node, part = group.column("node").to_numpy(), group.column("part").to_numpy()
        words = np.stack([group.column(c).to_numpy().view(np.uint64) for c in names], axis=1)
        column = group.column("hashes").combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        ends, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        left, right = np.flatnonzero(part == part.min()), np.flatnonzero(part == part.max())
        found = np.array(similar_links(words, sets, left, right, radius, least), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    pairs = placed.select("group", F.explode(meet).alias("pair"), "part", "node", *names, "hashes")
    return pairs.groupBy("group", "pair").applyInArrow(run, "a long, b long")


def representatives(docs: DataFrame, width: int = 5, similarity: float = 0.8, n_words: int = 4) -> DataFrame:
    """One row of each group of near duplicates in ``docs``, all columns kept: that of smallest doc_id.

    Documents link if the Jaccard similarity of their sets of word shingles is at least
    ``similarity``. Fingerprints of 64 * n_words bits over the distinct shingles only
    propose: those within a share of CANDIDATES of the bits, of set sizes that can have
    that similarity, form rough groups, and inside a rough group the links are taken from
    the sets themselves. Both ends of a true link are in one rough group, so it does not
    matter which links the forest of the rough group has. Rows without doc_id stand behind
    all others; of rows alike in id one stays.
    """
    radius = int(CANDIDATES * 64 * n_words)
    names = [f"f{i}" for i in range(n_words)]
    keyed = key_columns(docs.select("doc_id", "text"))[0].select("_noid", "_id", "text")
    prints = written(shingle_sets(keyed, width, n_words, False), "prints")
    size_class = F.floor(F.log(F.greatest(F.col("n_shingles"), F.lit(1)).cast("double")) / float(-np.log(similarity))).cast("int")
    first = F.min(F.struct("_noid", "_id")).alias("first")
    distinct = written(prints.groupBy("node", *names, "n_shingles").agg(first).withColumn("cls", size_class), "distinct", prints)
    rough = written(components(links(distinct.select("node", *names, "n_shingles", "cls"), n_words, radius, 1, similarity)).withColumnRenamed("root", "group"), "rough")
    asked = rough.join(distinct, "node").select("first._noid", "first._id").distinct()
    sets = shingle_sets(keyed.join(asked, ["_noid", "_id"]).select("text"), width, n_words, True)
    members = written(rough.join(sets, "node").dropDuplicates(["node"]), "members", rough)
    roots = components(confirmed(members, n_words, radius, similarity))
    placed = distinct.join(roots, "node", "left").select("first", F.coalesce("root", "node").alias("root"))
    rows, last, key = key_columns(docs)
    stay = placed.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._noid").alias(last), F.col("first._id").alias(key))
    return rows.join(stay, [last, key]).dropDuplicates([last, key]).select(*docs.columns)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
