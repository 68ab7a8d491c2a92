"""Operators 1, 2, 3, 4 and 5 against brute force."""

import hashlib
import re
import time
import zlib
from collections import defaultdict

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hazeline.llm import licenses, mixing, mtree, simhash, suffix


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_print(text, width=4):
    w = words(text)
    grams = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_equals_all_pairs(spark, sf):
    docs = cases.given(spark, sf)
    got = cases.sorted_rows(simhash.near_duplicates(docs), ["doc_id", "fingerprint", "component_id"])
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    prints = sorted({p for _, p in rows})
    up = {p: p for p in prints}

    def find(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                up[find(a)] = find(b)
    least = defaultdict(list)
    for d, p in rows:
        if d is not None:
            least[find(p)].append(d)
    want = sorted(((d, f"{p:016x}", min(least[find(p)], default=None)) for d, p in rows), key=repr)
    assert got == want


def test_simhash_of_no_rows(spark):
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_link_blocks_finds_every_component():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    w = np.unique(np.concatenate((base, near)))
    links = simhash.link_blocks(w[:, None], np.arange(len(w)), np.arange(len(w)), 4, tile=16)
    up = list(range(len(w)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        assert (int(w[a]) ^ int(w[b])).bit_count() <= 4
        up[find(a)] = find(b)
    for a in range(len(w)):
        for b in range(a):
            if (int(w[a]) ^ int(w[b])).bit_count() <= 4:
                assert find(a) == find(b)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def test_mixing_meets_targets(spark, sf):
    docs = cases.given(spark, sf).where("doc_id is null or doc_id <> 10030")  # half of its source: whole copies can't be near
    got = mixing.mixed_rows(docs).toPandas()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
    got["source"] = got["source"].where(got["source"].notna(), None)
    assert len(got) == docs.count() and set(got["copies"]) <= {0, 1, 2}
    for s, own in got.groupby("source", dropna=False):
        s = None if isinstance(s, float) else s
        assert own["target"].iloc[0] == pytest.approx(target[s], rel=1e-9)
        assert own["source_size"].iloc[0] == sizes[s]
        taken = (own["copies"] * own["size"]).sum()
        assert abs(taken - target[s]) <= max(0.02 * target[s], 40)
    again = mixing.mixed_rows(docs.repartition(3)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert sorted(map(repr, got[key].values.tolist())) == sorted(map(repr, again[key].values.tolist()))


def test_mixing_of_empty_tables_and_texts(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
    rows = cases.table(spark).where("text is null or trim(text) = ''")
    assert {(r.size, r.target, r.copies) for r in mixing.mixed_rows(rows).collect()} == {(0, 0.0, 0)}


def test_rates_are_tilted_and_meet_the_dual(spark, sf):
    sizes = mixing.sized(cases.given(spark, sf))
    for r in mixing.dual(sizes, mixing.targets(sizes)).collect():
        own = np.array([x.size for x in sizes.where(F.col("source").eqNullSafe(r.source)).select("size").collect()])
        if r.lam is not None:
            assert (own * np.minimum(2, np.exp(r.lam * own / r.mean))).sum() == pytest.approx(r.target, rel=1e-6)


def test_mixing_of_repeated_rows_keeps_to_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPREAD", 100)
    rows = [(None if i % 3 else 7, "same text of five words", "s", 1) for i in range(600)] + [(i, "w " * (i % 40 + 1), "s", 1) for i in range(1000, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long").withColumn("m", F.lit("own"))
    got = mixing.mixed_rows(docs, share=1.3).toPandas()
    assert len(got) == 1000 and set(got["copies"]) <= {0, 1, 2}
    target = got["target"].iloc[0]
    assert (got["copies"] * got["size"]).sum() == pytest.approx(target, rel=0.005)
    out = mixing.taken(docs, share=1.3)
    assert out.columns == docs.columns and {tuple(r) for r in out.select("copies", "m").distinct().collect()} == {(1, "own")}
    assert out.select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] == pytest.approx(target, rel=0.005)


def brute_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = {label: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
    every = sorted(i for x in at.values() for i in x)
    k = licenses.K
    more, best = set(), 0.0
    own = defaultdict(list)
    for i in range(len(w) - k + 1):
        own[tuple(w[i : i + k])].append(i)
    for label, body in licenses.TEMPLATES:
        t = re.findall(r"[a-z0-9]+", body.lower())
        hits = defaultdict(set)
        for j in range(len(t) - k + 1):
            for i in own.get(tuple(t[j : j + k]), ()):
                hits[i - j].add(j)
        island, last = set(), None
        for d in [*sorted(hits), None]:
            if d is None or last is not None and d - last > licenses.GAP:
                if island and len(island) / (len(t) - k + 1) >= licenses.COVER:
                    more.add(label)
                    best = max(best, len(island) / (len(t) - k + 1))
                island = set()
            if d is not None:
                island |= hits[d]
            last = d
    base = sorted(x for x, y in at.items() if y)
    return len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(base), ",".join(sorted({*base, *more})), 1.0 if every else best


def test_licenses_equal_brute_force(spark, sf):
    docs = cases.given(spark, sf)
    got = cases.sorted_rows(licenses.scan(docs), ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    want = sorted(((r.doc_id, *brute_licenses(r.text)) for r in docs.collect()), key=repr)
    assert got == want
    assert any("apache-2.0" in x[6] for x in got)
    assert licenses.scan(cases.empty(spark)).count() == 0


def test_license_spans_survive_an_inserted_word(spark):
    docs = spark.createDataFrame([(1, "x This work is licensed under the very GNU General Public License, version 3 y")], "doc_id long, text string")
    assert {r.label: (r.first_word, r.last_word) for r in licenses.spans(docs).collect()}["gpl-3.0"] == (1, 13)


def test_license_bodies_and_long_texts(spark, monkeypatch):
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 900)
    docs = spark.createDataFrame([(1, "head " + mit.replace("modify", "alter") + " tail"), (2, "license " * 200_000 + "licensed under cc by 4.0")], "doc_id long, text string")
    want = {1: (len(brute_words(mit)) + 2, "mit"), 2: (200_006, "cc-by,cc-by-4.0")}
    for bound in (licenses.MOST_TEMPLATE_WORDS, 10):  # with the templates broadcast, and shuffled
        monkeypatch.setattr(licenses, "MOST_TEMPLATE_WORDS", bound)
        assert {r.doc_id: (r.n_words, r.labels) for r in licenses.scan(docs).collect()} == want


def brute_words(text):
    return re.findall(r"[a-z0-9]+", text.lower())


def brute_cut(rows, width=50):
    raws = [((10**18 if i is None else i), (t or "").encode()) for i, t in rows]
    least = {}
    for i, raw in raws:
        for s in {raw[a : a + width] for a in range(len(raw) - width + 1)}:
            least[s] = min(i, least.get(s, 10**18))
    out = []
    for (i, raw), (doc_id, _) in zip(raws, rows):
        gone = bytearray(len(raw))
        for a in range(len(raw) - width + 1):
            if least[raw[a : a + width]] < i:
                gone[a : a + width] = b"\1" * width
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup_equals_brute_force(spark, sf, monkeypatch):
    docs = cases.given(spark, sf)
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "hash"]
    want = brute_cut([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for size in (suffix.SLICE, 20_000):
        monkeypatch.setattr(suffix, "SLICE", size)
        monkeypatch.setattr(suffix, "BATCH", 30_000)
        got = suffix.dedup(docs.repartition(3)).withColumn("hash", F.sha2("kept", 256))
        assert cases.sorted_rows(got, cols) == want
    assert sum(r[2] for r in want) > 1000
    assert suffix.dedup(cases.empty(spark)).count() == 0


def test_suffix_texts_without_id_and_of_one_crc_stay_apart(spark):
    passage = "".join(chr(97 + i * i * 7 % 26) + str(i) for i in range(60))
    other = "nothing of this text stands anywhere else, it is only as long as the passage before it, so that a cut shows "
    tail = [hashlib.md5(str(i).encode()).hexdigest() for i in range(200_000)]
    tails = {zlib.crc32(f"{passage} {x}".encode()): x for x in tail}
    i, j = next((tails[c], x) for x in tail if (c := zlib.crc32(f"{other} {x}".encode())) in tails)
    rows = [(1, passage), (None, f"{passage} {i}"), (None, f"{other} {j}"), (None, None), (None, "")]
    got = suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("hash", F.sha2("kept", 256))
    want = brute_cut(rows)
    got = [(10**18 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.hash) for r in got.collect()]
    assert sorted(got) == sorted((10**18 if r[0] is None else r[0], *r[1:]) for r in want)


def test_suffix_texts_of_short_common_strings_are_not_sent():
    """Strings of 16 bytes recur by chance in large tables; a text goes out only for 33 common bytes or more."""
    rng = np.random.default_rng(0)

    def asked(common):
        filler = lambda: rng.integers(97, 123, 40).astype(np.uint8).tobytes()
        texts = [b"".join(filler() + c for c in common) + filler() for _ in range(2)]
        rows = [r for i, t in enumerate(texts) for r in suffix.ask_slice(suffix.Slice([(i, i, 0, t)], 50), 1)]
        return sum(map(len, suffix.shared_numbers({k: [r[k] for r in rows] for k in rows[0]})[2]))

    common = [rng.integers(97, 123, 80).astype(np.uint8).tobytes() for _ in range(50)]
    assert asked([c[:24] for c in common]) == 0
    assert asked(common) > 0


def test_suffix_of_a_key_too_common_for_one_array(monkeypatch):
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 60).astype(np.uint8).tobytes()
    texts = [bytes(rng.choice([97, 98], i % 4).astype(np.uint8)) + passage + bytes(rng.choice([97, 98], i % 3).astype(np.uint8)) for i in range(200)]
    part = suffix.Slice([(i, i, 0, t) for i, t in enumerate(texts)], 50)
    shard = suffix.send_slice(part, [np.unique(part.numbers())] * len(part.pieces), 1)[1][0]
    cols = [*suffix._owners({k: [v] for k, v in shard.items()}, 0), *(suffix._unpacked(shard[c], k).astype(np.int64) for c, k in (("start", np.int64), ("length", np.int16), ("place", np.uint8)))]
    body = suffix.zstandard.ZstdDecompressor().decompress(shard["body"])
    whole = sorted(zip(*(x.tolist() for x in suffix.settle_shard(*cols, body))))
    monkeypatch.setattr(suffix, "_smallest", None)
    assert sorted(zip(*(x.tolist() for x in suffix.settle_shard(*cols, body, batch=100)))) == whole
    assert whole


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_sorts(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    t = rng.integers(97, 97 + int(rng.integers(1, 6)), n).astype(np.uint8)
    raw = t.tobytes()
    order = suffix.suffix_array(t)
    assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
    shared = suffix.permuted_prefixes(t, order, 50)
    for a, b in zip(order[:-1], order[1:]):
        k = 0
        while k < 50 and max(a, b) + k < n and raw[a + k] == raw[b + k]:
            k += 1
        assert min(shared[b], n - max(a, b)) == k
    short = suffix.suffix_array(t, depth=6)
    assert [raw[i : i + 6] for i in short] == sorted(raw[i : i + 6] for i in range(n))


def brute_topk(rows, k=10, every=100):
    good = [(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(good):
        if q is not None and q % every == 0:
            found = sorted(((-sum(x * y for x, y in zip(v, u)), i is None, i) for b, (i, u) in enumerate(good) if b != a), key=lambda x: (x[0], x[1], x[2] or 0))
            out += [(q, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def test_topk_equals_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(mtree, "CANDIDATES", 200)
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    odd = list(data[0][1])
    data += [(None, data[1][1]), (9001, None), (9002, [None, *odd[1:]]), (9003, [float("nan"), *odd[1:]]), (9004, [float("inf"), *odd[1:]]), (9100, data[3][1]), (9100, data[3][1]), data[5], data[5], (9200, [0.0] * 64)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = cases.sorted_rows(mtree.top_k(df), ["query_id", "rank", "vec_id", "score"])
    assert got == brute_topk([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in data])
    assert mtree.top_k(df.limit(0)).count() == 0


def test_mtree_leaves_out_work_on_clusters():
    rng = np.random.default_rng(0)
    centres = rng.integers(-900, 900, (40, 8))
    x = np.concatenate([c + rng.integers(-9, 10, (100, 8)) for c in centres])
    top = float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max())) * (1 + 1e-12)
    tree = mtree.MTree(x, top)
    ids, copies = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
    total = 0
    for q in range(0, len(x), 97):
        found, computed = tree.search(x[q], 10, q, ids, copies)
        scores = x @ x[q]
        scores[q] = -(10**15)
        best = np.lexsort((ids, -scores))[:10]
        assert found == [(int(scores[i]), int(i)) for i in best]
        total += computed
    assert total < 0.5 * len(x) * len(range(0, len(x), 97))


@pytest.mark.parametrize("spread", [3, 900, 2**30])
def test_mtree_answers_many_queries_at_once(spread):
    rng = np.random.default_rng(spread)
    x = np.concatenate([rng.integers(-spread, spread, (300, 6)), np.zeros((70, 6), dtype=np.int64)])
    tree = mtree.MTree(x, float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max())) * (1 + 1e-12))
    ids, copies = rng.permutation(len(x)), rng.integers(1, 3, len(x))
    asked = np.append(np.arange(0, len(x), 7), -1)
    q = np.concatenate([x[asked[:-1]], rng.integers(-spread, spread, (1, 6))])
    n, score, row, _ = tree.search_all(q, 10, asked, ids, copies)
    scores = q.astype(object) @ x.T.astype(object)
    for i, me in enumerate(asked):
        rows = [r for r in range(len(x)) if r != me or copies[r] > 1]
        want = sorted(rows, key=lambda r: (-scores[i, r], ids[r]))[:10]
        assert list(zip(score[n == i].tolist(), row[n == i].tolist())) == [(scores[i, r], r) for r in want]


def test_topk_of_a_block_takes_matrix_products(spark):
    x = np.random.default_rng(2).integers(-300, 300, (20_000, 64))
    tree = mtree.MTree(x, float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max())) * (1 + 1e-12))
    began = time.thread_time()
    assert len(tree.search_all(x[:1000], 10, np.arange(1000), np.arange(len(x)), np.ones(len(x), dtype=np.int64))[0]) == 10_000
    assert time.thread_time() - began < 8
    odd = spark.createDataFrame([(100, []), (1, []), (200, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert cases.sorted_rows(mtree.top_k(odd), ["query_id", "rank", "vec_id", "score"]) == [(100, 1, 1, 0), (200, 1, 2, 1024 * 2048)]
