"""Searches, near-duplicates, quality and page text."""

from __future__ import annotations

import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import components, forest, html_main, line_dedup, prefixes, quality, simhash, va_search


def roots(n, links):
    """Smallest member of each one's group, by plain union."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(0)
    links = [(i, i + 1) for i in range(0, 200)] + [(300, i) for i in range(301, 400)] + [(500, 500), (601, 600)]
    links += [(draw.randrange(700, 1000), draw.randrange(700, 1000)) for _ in range(200)] + [(601, 600), (None, 4)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = roots(1000, [x for x in links if None not in x])
    touched = {x for a, b in links if None not in (a, b) and a != b for x in (a, b)}
    assert {r.node: r.component for r in found} == {x: wanted[x] for x in touched}
    assert len(found) == len(touched)
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_top(rows, k, every):
    out = []
    for q, x in rows:
        if q % every == 0:
            ranked = sorted(((-int(x @ y), i) for i, y in rows if i != q))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


def test_top_k_with_ties_blocks_and_bad_vectors(spark, rows_of):
    draw = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in draw.integers(-3, 4, (300, 5)) / 4]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(7, vectors[7], 1)]
    bad = [(400, None, 0), (410, [1.0, None, 0.0, 0.0, 0.0], 0), (420, [float("nan")] * 5, 0), (430, [float("inf")] * 5, 0)]
    bad += [(None, vectors[0], 0), (440, [], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score int")
    wanted = brute_top([(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in enumerate(vectors)], 4, 10)
    for bits in (1, 4, 8):
        found = va_search.top_k(df, lambda i: i % 10 == 0, 4, bits=bits, block=50, query_block=7)
        assert rows_of(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)
    assert va_search.top_k(df.limit(0), lambda i: i % 10 == 0).collect() == []
    few = va_search.top_k(df.where("vec_id < 3"), lambda i: i % 10 == 0, 4)
    assert [(r.rank, r.vec_id) for r in few.orderBy("rank").collect()] == [(r[1], r[2]) for r in brute_top(
        [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in enumerate(vectors[:3])], 4, 10)]


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 3.0]), (3, [0.5, 1e300]), (4, [1e5, -1e5]), (5, [2e5, 0.25])]
    found = va_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i >= 0, 3)
    limit = math.floor(math.sqrt(2**62 / 2))
    v = {i: [max(-limit, min(limit, math.floor(1024 * c))) for c in x] for i, x in rows}
    wanted = []
    for q in v:
        ranked = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in v if i != q)[:3]
        wanted += [(q, rank, i, -score) for rank, (score, i) in enumerate(ranked, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_top_k_compares_vectors_of_one_length(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in va_search.top_k(df, lambda i: i == 0).collect()] == [2]


def near_by_force(rows, threshold):
    """(n_links, component) by comparing all pairs."""
    links, count = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if p is None or p != q or x is None or y is None or len(x) != len(y):
                continue
            x, y = np.array(x, np.float64), np.array(y, np.float64)
            if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
                continue
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    return count, roots(len(rows), links)


@pytest.mark.parametrize("leaf", [16, 64, 2000])
def test_forest_finds_all_links(spark, leaf):
    draw = np.random.default_rng(leaf)
    centres = draw.standard_normal((40, 16))
    rows = []
    for i in range(500):
        v = centres[i % 40] * draw.uniform(0.5, 2) + (0.12 * draw.standard_normal(16) if i % 3 else 0)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 40 < 30)))
    rows += [(500, rows[0][1], rows[0][2]), (501, [0.0] * 16, 1), (502, None, 1), (503, [float("nan")] * 16, 1)]
    rows += [(504, rows[3][1], None), (505, rows[3][1][:8], 1), (506, [1.0] * 16, 1), (507, [2.0] * 16, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    count, root = near_by_force(rows, 0.93)
    found = {r.vec_id: r for r in forest.near_vectors(df, leaf=leaf, block=24, trees=16).collect()}
    assert len(found) == len(rows)
    assert [found[i].n_links for i in range(len(rows))] == count
    assert [found[i].component_id for i in range(len(rows))] == root
    assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_forest_finds_links_of_a_large_tight_group(spark):
    draw = np.random.default_rng(12)
    noise = draw.standard_normal((2500, 64)) * np.sqrt(0.06 / 64)
    rows = forest.unit_rows(pa.array((noise + np.eye(64)[0]).tolist()))
    links = int((rows @ rows.T >= 0.93).sum()) - len(rows)
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate(rows.tolist())], "vec_id long, label string, embedding array<double>")
    found = forest.near_vectors(df, leaf=80, block=80).agg(F.sum("n_links")).first()[0]
    assert links > 100_000 and 0.99 * links <= found <= links


def test_trees_grow_until_the_links_of_a_sample_are_found(spark):
    draw = np.random.default_rng(3)
    noise = draw.standard_normal((700, 64)) * np.sqrt(0.06 / 64)
    rows = forest.unit_rows(pa.array((noise + np.eye(64)[0]).tolist()))
    links = int((rows @ rows.T >= 0.93).sum()) - len(rows)
    points = [(i, "a", v, 1) for i, v in enumerate(rows.tolist())] + [(700 + i, "b", v, 1) for i, v in enumerate(rows[:40].tolist())]
    points = spark.createDataFrame(points, "uid long, label string, v array<double>, copies long")
    single = forest.grow(points, 0.93, 1, 80, 0.0, 7, 0, 1).where("pmod(xxhash64(node), 3) = 0")
    few = forest.compare(single, points, 0.93, 80)
    assert few.agg(F.sum("links")).first()[0] < 0.9 * links
    assert [r.label for r in forest.short_labels(points, few, 0.93, 80, 7).collect()] == ["a"]
    found = forest.all_links(points, 0.93, 1, 80, 0.0, 80, 7)
    assert 0.98 * links <= found.where("uid < 700").agg(F.sum("links")).first()[0] <= links
    assert "v" not in forest.grow(points, 0.93, 1, 80, 0.0, 7).columns


def test_links_of_a_label_of_twenty_leaves(spark):
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((60, 32))
    rows = forest.unit_rows(pa.array([(centres[i % 60] + 0.2 * draw.standard_normal(32)).tolist() for i in range(2400)]))
    near = rows @ rows.T >= 0.93
    wanted = near.sum(axis=1) - 1
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(rows.tolist())], "vec_id long, label int, embedding array<double>")
    found = {r.vec_id: r.n_links for r in forest.near_vectors(df, leaf=120, block=100).collect()}
    assert all(found[i] <= wanted[i] for i in found) and sum(found.values()) >= 0.99 * wanted.sum() > 10_000


def test_a_label_that_fits_in_a_leaf_has_one_tree(spark):
    draw = np.random.default_rng(5)
    rows = [(i, i % 2, draw.standard_normal(8).tolist()) for i in range(400)] + [(i, 2, draw.standard_normal(8).tolist()) for i in range(400, 500)]
    points = spark.createDataFrame([(u, label, v, 1) for u, label, v in rows], "uid long, label int, v array<double>, copies long")
    leaves = forest.grow(points, 0.93, 10, 150, 0.25, 7).groupBy("uid").agg(F.count("*").alias("n"))
    assert leaves.where("uid >= 400 and n <> 1").isEmpty() and leaves.where("uid < 400 and n < 10").isEmpty()


def test_forest_keeps_a_tight_group_whole(spark):
    draw = np.random.default_rng(1)
    centre = draw.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 1e-3 * draw.standard_normal(16)], 1) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = forest.near_vectors(df, leaf=32, block=50).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(299, 0)}
    assert forest.near_vectors(df.limit(0)).collect() == []


def fingerprint_by_force(text, width=3):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_is_brute_force(table, result):
    docs = table("documents").toPandas().sort_values("doc_id").reset_index(drop=True)
    fps = [fingerprint_by_force(t) for t in docs.text]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    root = roots(len(fps), links)
    found = result("op9_simhash").set_index("doc_id")
    assert [found.loc[i].fingerprint for i in docs.doc_id] == [f"{f:016x}" for f in fps]
    assert [found.loc[i].component_id for i in docs.doc_id] == [docs.doc_id[r] for r in root]


def test_links_of_fingerprints_up_to_two_bits_apart(spark):
    draw = random.Random(5)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(120):
        f = draw.getrandbits(64)
        fps.add(f)
        for flips in (1, 2, 3, 4):
            fps.add(f ^ sum(1 << b for b in draw.sample(range(64), flips)))
    order = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in order], "fp long")
    pairs = [(order.index(r.a % (1 << 64)), order.index(r.b % (1 << 64))) for r in simhash.near_links(df).collect()]
    assert all((order[a] ^ order[b]).bit_count() <= 2 for a, b in pairs)
    wanted = [(a, b) for a in range(len(order)) for b in range(a) if (order[a] ^ order[b]).bit_count() <= 2]
    assert roots(len(order), pairs) == roots(len(order), wanted)


def test_pivot_distances_bound_the_distance(spark):
    draw = random.Random(2)
    pairs = [(draw.getrandbits(63), draw.getrandbits(63)) for _ in range(50)]
    df = spark.createDataFrame(pairs, "a long, b long")
    a, b = (F.array(*simhash.pivot_distances(F.col(c))) for c in "ab")
    gap = F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    assert df.where(gap > F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).count() == 0


def test_near_duplicates_of_odd_texts(odd_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].component_id for i in (0, 1, 2)} == {0} and by_id[0].fingerprint == "0" * 16
    assert by_id[None].component_id is None and by_id[3].component_id == 3
    assert simhash.near_duplicates(odd_docs.limit(0)).collect() == []


def test_keep_one_keeps_one(spark, odd_docs, rows_of):
    draw = random.Random(4)
    base = [" ".join(f"w{draw.randrange(5000)}" for _ in range(400)) for _ in range(40)]
    rows = []
    for i, text in enumerate(base):
        rows.append((3 * i, text))
        words = text.split()
        for at in draw.sample(range(400), 4):
            words[at] = "changed"
        rows.append((3 * i + 1, " ".join(words)))
        rows.append((3 * i + 2, text.upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # A few-word edit of 400 leaves at least 0.9 of the shingles; all copies go, no other text does.
    assert [r[0] for r in rows_of(kept.orderBy("doc_id"), "doc_id")] == sorted((3 * i for i in range(40)), key=lambda x: repr((x,)))
    odd = simhash.keep_one(odd_docs)
    assert odd.columns == odd_docs.columns
    # Two lines of the same words differ from one of them; the blank texts and the repeated row are one each.
    assert sorted((r.doc_id for r in odd.collect()), key=str) == sorted([0, 3, 4, 5, 6, 7, 8, None], key=str)
    assert simhash.keep_one(odd_docs.limit(0)).collect() == []


def family(draw, singles, pairs, template=120, private=30, changed=10):
    """Texts that share a template, each with words of its own; every text of the last `pairs` has a near-copy behind it."""
    shared = [f"t{i}" for i in range(template)]
    texts = []
    for i in range(singles + pairs):
        own = [f"p{draw.randrange(10**9)}" for _ in range(private)]
        texts.append(shared + own)
        if i >= singles:
            texts.append(shared + own[: private - changed] + [f"q{draw.randrange(10**9)}" for _ in range(changed)])
    return [" ".join(t) for t in texts]


def kept_by_force(texts, similarity=0.8):
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if common >= similarity * (len(x) + len(sets[j]) - common):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(set(root))


def test_keep_one_compares_all_rows_of_a_crowded_cell(spark, rows_of):
    texts = family(random.Random(9), 500, 100)
    expected = kept_by_force(texts)
    assert len(expected) == 600
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r[0] for r in rows_of(simhash.keep_one(docs), "doc_id")) == expected


def test_unlike_texts_of_a_template_leave_no_pairs(spark, monkeypatch):
    """Texts that share a template but are no copies are compared inside the tasks: links leave them, not pairs."""
    texts = family(random.Random(10), 500, 30)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = []
    plain = simhash.crowded_pairs
    monkeypatch.setattr(simhash, "crowded_pairs", lambda *a: left.append(simhash.materialize(plain(*a))) or left[-1])
    assert simhash.keep_one(docs).count() == 530
    assert left and sum(df.count() for df in left) <= 60


@pytest.mark.parametrize("block", [8, 512])
def test_crowded_cells_are_compared_whole(spark, block):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 64, 4, np.uint64, endpoint=False)
    fps = [(i, (base ^ (np.uint64(1) << draw.integers(0, 64, 4, np.uint64))).view(np.int64).tolist(), 50) for i in range(60)]
    known = spark.createDataFrame([(i, i % 2) for i in range(20)], "node long, component long")
    cells = spark.createDataFrame([(c, i, 60) for c in (5, 6) for i in range(60)], "cell long, uid long, n long")
    rows = simhash.mixed_cells(cells, known)
    found = simhash.crowded_pairs(rows, spark.createDataFrame(fps, "uid long, fp array<long>, size int"), 4, [7], block)
    root = [i % 2 if i < 20 else i for i in range(60)]
    values = [[w & (1 << 64) - 1 for w in fp] for _, fp, _ in fps]
    apart = {(i, j): sum((x ^ y).bit_count() for x, y in zip(values[i], values[j])) for j in range(60) for i in range(j)}
    assert {(r.a, r.b): r.differ for r in found.collect()} == {
        (i, j): d for (i, j), d in apart.items() if d <= 7 and root[i] != root[j]
    }


def test_rows_of_crowded_cells_grow_as_the_rows_do():
    """Unlike rows that meet by chance: five times the rows make no more than some five times the rows in cells of over three."""
    draw = np.random.default_rng(12)

    def crowded(count):
        masks, usual = simhash.bit_subsets(count, 4, 0.8, 0.995)
        some = np.array(masks[:usual:8])
        fps, odd = draw.integers(-(1 << 63), 1 << 63, (count, 4)), draw.integers(1, 1 << 62, 4) * 2 + 1
        found = 0
        for mask in some:
            n = np.unique((fps & mask) @ odd, return_counts=True)[1]
            found += n[n > 3].sum()
        return found * usual / len(some)

    for count in (44_000, 60_000):
        assert crowded(5 * count) < 6.5 * crowded(count)


@pytest.mark.parametrize("count", [1_000, 44_000, 90_000, 220_000])
def test_subsets_bring_pairs_of_the_similarity_together(count):
    masks, usual = simhash.bit_subsets(count, 4, 0.8, 0.995)
    bits = np.unpackbits(np.array(masks[:usual], ">i8").view(np.uint8), axis=1).astype(np.float32)
    differ = np.random.default_rng(13).random((10_000, 256)) < simhash.bit_chance(0.8)
    assert ((differ.astype(np.float32) @ bits.T) == 0).any(axis=1).mean() > 0.993
    assert simhash.bit_subsets(2, 1, 0.8, 0.9)[1] > 0 and simhash.subset_sizes(1 << 400, 256) == (256, 0.0)


def test_keep_one_settles_every_pair_by_its_shingles(spark, rows_of):
    draw = random.Random(6)
    texts = []
    for i in range(150):
        words = [f"s{draw.randrange(10**9)}" for _ in range(20)]
        # Eight and nine words are 4 and 5 shingles, 0.8; 11 and 13 words share 7 of 9, 0.78.
        texts += [" ".join(words[:8]), " ".join(words[:9])]
        other = [f"u{draw.randrange(10**9)}" for _ in range(20)]
        texts += [" ".join(other[:11]), " ".join(other[:13])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = kept_by_force(texts)
    assert len(expected) == 450
    kept = {r[0] for r in rows_of(simhash.keep_one(docs), "doc_id")}
    assert kept >= set(expected) and len(kept - set(expected)) <= 1


def test_keep_one_finds_pairs_that_no_cell_brings_together(spark, rows_of, monkeypatch):
    """All pairs of the similarity count, whatever the subsets of the bits are; here none of them brings two unlike rows together."""
    plain = simhash.bit_subsets
    monkeypatch.setattr(simhash, "bit_subsets", lambda *a: ([[-1] * 4], plain(*a)[1]))
    draw = random.Random(16)
    texts = family(draw, 60, 20)
    for i in range(60):
        words = [f"v{draw.randrange(10**9)}" for _ in range(120)]
        changed = [*words[:-8], *(f"y{draw.randrange(10**9)}" for _ in range(8))]
        texts += [" ".join(words), " ".join(changed), " ".join(words[4 : draw.randrange(90, 116)])]
    texts += [" ".join(f"z{i}" for i in range(n)) for n in (1, 3, 8, 9, 10, 12)] * 2
    expected = kept_by_force(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r[0] for r in rows_of(simhash.keep_one(docs), "doc_id")) == expected


@pytest.mark.parametrize("block", [4, 1024])
def test_sets_of_the_similarity_share_an_early_member(spark, monkeypatch, block):
    """Every pair of the similarity is named, packed in one part or in many; pairs of one group are not."""
    monkeypatch.setattr(prefixes, "PACKED", 1 << 20 if block > 4 else 100)
    draw = random.Random(17)
    sets = [frozenset(draw.sample(range(60), draw.randrange(1, 25))) for _ in range(60)]
    sets += [frozenset(draw.choice(sets) ^ set(draw.sample(range(60), draw.randrange(4)))) for _ in range(120)]
    sets = sorted({x for x in sets if x}, key=sorted)
    texts = spark.createDataFrame([(" ".join(map(str, x)),) for x in [*sets, *sets[:30]]] + [("",)], "text string")

    def members(text):
        return np.unique(np.array([xxhash.xxh64_intdigest(w) for w in text.split()], np.uint64))

    first = prefixes.shared_first(texts, members, simhash.set_key, 10**9, 0.8).toPandas()
    keys = [simhash.set_key(members(" ".join(map(str, x)))) for x in sets]
    first["uid"] = first.s.map({k: i for i, k in enumerate(keys)})
    assert len(first) == len(first.drop_duplicates(["uid", "member"])) > 0
    rows = spark.createDataFrame(first.assign(root=first.uid // 3)[["uid", "root", "size", "at", "member"]])
    found = {tuple(r) for r in prefixes.possible_pairs(rows, 0.8, block).collect()}
    alike = {(i, j) for j in range(len(sets)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert found >= {(i, j) for i, j in alike if i // 3 != j // 3} and not any(i // 3 == j // 3 for i, j in found)
    assert len(alike) > 30 and len(found) < len(sets) * (len(sets) - 1) / 4


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def lines_by_force(docs, near_words):
    spots = [(i, p, line.split()) for i, t in docs for p, line in enumerate((t or "").split("\n"))]
    firsts = {}
    for i, p, w in sorted(spots, key=lambda s: (s[0] is None, s[0] or 0, s[1])):
        firsts.setdefault(tuple(w), (i is None, i or 0, p))
    near = {
        b
        for b in firsts
        if any(
            min(len(a), len(b)) >= near_words and a != b and firsts[a] < firsts[b] and abs(len(a) - len(b)) < 2 and edits(a, b) < 2
            for a in firsts
        )
    }
    out = []
    for i, t in docs:
        kept = [
            line
            for p, line in enumerate((t or "").split("\n"))
            if not line.split() or (tuple(line.split()) not in near and firsts[tuple(line.split())] == (i is None, i or 0, p))
        ]
        out.append((i, None if t is None else "\n".join(kept)))
    return out


@pytest.mark.parametrize("near_words", [3, 5])
def test_line_dedup_is_brute_force(spark, rows_of, near_words):
    draw = random.Random(near_words)
    words = "a b c d e".split()
    base = [[draw.choice(words) for _ in range(draw.randrange(1, 9))] for _ in range(25)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(draw.randrange(6)):
            line = list(draw.choice(base))
            for _ in range(draw.choice([0, 1, 1, 2])):
                kind, at = draw.choice("ars"), draw.randrange(len(line) + 1)
                if kind == "a":
                    line.insert(at, draw.choice([*words, "z", "y"]))
                elif at < len(line):
                    line[at : at + 1] = [] if kind == "r" else [draw.choice([*words, "z"])]
            lines.append(draw.choice([" ", "  "]).join(line))
        docs.append((i, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (None, docs[0][1] + "\nonly here"), (103, "a b c d e f g\n\nq")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, pos int, h1 string")
    found = line_dedup.dedup_lines(df, near_words=near_words)
    assert found.columns == [*df.columns, "n_dropped"]
    assert rows_of(found, "doc_id", "text") == sorted(lines_by_force(docs, near_words), key=repr)


def test_line_dedup_of_odd_texts(odd_docs):
    found = line_dedup.dedup_lines(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].text is None and by_id[1].text == "" and by_id[2].text == "  \n\t "
    assert by_id[4].text == "the same line of seven words here" and by_id[4].n_dropped == 1
    assert by_id[8].text == "" and [r.text for r in found if r.doc_id == 3] == ["a"] * 3
    assert line_dedup.dedup_lines(odd_docs.limit(0)).collect() == []


def test_line_dedup_stays_in_the_jvm(odd_docs):
    plan = line_dedup.dedup_lines(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_one_edit_apart(spark):
    draw = random.Random(9)
    pairs = [([draw.choice("ab") for _ in range(draw.randrange(6))], [draw.choice("ab") for _ in range(draw.randrange(6))]) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    found = df.select("a", "b", line_dedup.within_one_edit(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r.near == (edits(r.a, r.b) < 2) for r in found)


def test_quality_on_held_out_rows(table, result, spark):
    found = result("op3_quality")
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = quality.classify(docs, labels.where(~quality.held_out("doc_id")))
    kept = scored.join(labels, "doc_id").where(quality.held_out("doc_id")).toPandas()
    print("held out:", len(kept), "right:", (kept.predicted == kept.quality).sum(), "junk found:", (kept[kept.quality == 0].predicted == 0).sum(), "of", (kept.quality == 0).sum())
    assert (kept.predicted == kept.quality).mean() >= 0.95
    assert kept[kept.quality == 1].predicted.mean() >= 0.97


def test_quality_uses_texts_alone(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1), (5, 0), (5, None), (99, 1), (None, 0), (6, 7)], "doc_id long, quality int")
    renamed = odd_docs.withColumn("score", F.lit("given"))
    found = quality.classify(renamed, labels).collect()
    assert len(found) == odd_docs.count() and found[0].score_given == "given"
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].score == 1 and by_id[5].score < 1e-9 and by_id[5].predicted == 0
    assert by_id[0].score == by_id[1].score == 0.5
    none = quality.classify(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(odd_docs.limit(0), labels).collect() == []


def test_votes_are_a_plain_weighted_vote(table):
    docs, labels = table("documents"), table("labels")
    model = quality.fit(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    texts = docs.where(F.col("doc_id").isin(list(known))).toPandas().sort_values("doc_id")
    terms = np.stack([quality.term_weights(t) for t in texts.text])
    places = model.place(terms, np.stack([quality.shape(t) for t in texts.text]))
    assert np.allclose(places, model.vectors, atol=2e-3)
    for t, place in list(zip(texts.text, places))[:20]:
        cosines = model.vectors @ place
        best = np.flatnonzero(cosines >= np.sort(cosines)[-quality.NEIGHBOURS])
        weights = np.maximum(cosines[best], 0) ** quality.POWER
        wanted = (weights * model.labels[best]).sum() / weights.sum()
        assert abs(model.score([t])[0] - wanted) < 1e-3


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies and more words than you would like to read here.</div>
<div id="content-7" class="post content"><h1>Title &amp; more</h1><p>First   <b>bold
text</b> goes<br>on<p>Second &eacute;&#233; <script>var a = "<p>no</p>";</script>part<!-- <p>gone</p> -->
<div class="ad"><p>Buy this</div><table><tr><td>cell<td>next</table><form><p>mail me</p></form></div>
<aside>More</aside><div class="comments"><p>Nice article, I liked to read it.</p></div><footer>&copy; 2020</footer>"""


def test_main_text_of_a_page():
    assert html_main.main_text(PAGE, None) == "Title & more\nFirst bold text goes on\nSecond éé part\ncell\nnext"
    assert html_main.main_text("", None) == "" and html_main.main_text("<p", None) == ""
    assert html_main.main_text("a < b &amp; <i>c</i>", "html>nowhere") == "a < b & c"
    assert html_main.main_text("<div>" * 5000 + "deep" + "</p>" * 5000, None) == "deep"


def test_main_text_of_sibling_blocks():
    first, second, menu = "a" * 300, "b" * 200, "m" * 500
    page = f'<body><nav>{menu}</nav><div class="x">{first}</div><div class="y">{second}</div></body>'
    assert html_main.main_text(page, None) == f"{first}\n{second}"
    assert html_main.main_text(f'<body><div class="x"><nav>{menu}</nav>{first}</div></body>', "body>div.x") == first


@pytest.mark.parametrize("shares", [(60, 40), (90, 10), (45, 55)])
def test_no_sibling_is_lost_to_the_host_path(shares):
    first, second = "a" * 50 * shares[0], "b" * 50 * shares[1]
    page = f'<body><nav>{"m" * 900}</nav><div class="x">{first}</div><div class="y">{second}</div></body>'
    for path in (None, "body>div.x", "body>div.y", "body"):
        assert html_main.main_text(page, path) == f"{first}\n{second}"


def test_a_form_around_the_page_is_the_page():
    story = "<h1>Title</h1><p>" + "story " * 200 + "</p><form><label>Mail</label><input><button>Send</button></form>"
    assert html_main.main_text(f"<body><form id=f><div>{story}</div></form></body>", None) == "Title\n" + ("story " * 200).strip()


@pytest.mark.parametrize("name", ["social-science", "related-work", "notice-of-results", "share-of-income"])
def test_a_word_in_a_name_is_no_proof(name):
    story, section = "story " * 100, "section " * 60
    assert html_main.main_text(f'<body><article class="{name}"><p>{story}</p></article></body>', None) == story.strip()
    assert html_main.main_text(f'<body><div class="{name}"><p>{story}</p></div></body>', None) == story.strip()
    page = f'<body><article><p>{story}</p><section class="{name}"><p>{section}</p></section></article></body>'
    assert html_main.main_text(page, None) == f"{story.strip()}\n{section.strip()}"
    links = f'<div class="{name}">' + "<a href=x>another story to read</a> " * 30 + "</div>"
    assert html_main.main_text(f"<body><article><p>{story}</p>{links}</article></body>", None) == story.strip()
    for sure in ("comments-area", "ad-slot-3", "cookie-notice", "sidebar"):
        assert html_main.main_text(f'<body><div><p>{story}</p><div class="{sure}"><p>{section}</p></div></div></body>', None) == story.strip()


def test_formulas_and_fallbacks_inside_the_article_stay():
    page = "<body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><noscript><p>shown</p></noscript></article><noscript>turn it on</noscript></body>"
    assert html_main.main_text(page, None) == "Let x=1 be\nshown"


@pytest.mark.parametrize("piece", ["<foo>x ", "<div><p>x", "<li>x", "</b>x<i>", "<td><x-y>", "<a 'x>y", "<!-x"])
def test_a_page_of_a_megabyte_takes_little_time(piece):
    start = time.perf_counter()
    html_main.main_text("<body>" + piece * (1_000_000 // len(piece)), "body>div.x")
    assert time.perf_counter() - start < 20


def test_pages_follow_their_host(spark):
    page = "<body><div class='frame'><h1>Head {n}</h1><article class='story {n}'>{text}</article></div><div class='extra'>{more}</div></body>"
    bare = "<body><div class='frame'><h1>Head {n}</h1><p>{text}</p></div><nav>menu</nav></body>"
    # Most pages of the host have all their text in the frame; where an article lies in it, the frame's other text stays.
    rows = [(i, f"http://Host.example/{i}", bare.format(n=f"s{i}", text=f"story {i} " * 30), "x") for i in range(7)]
    rows.append((7, "http://host.example:80/7", page.format(n="s7", text="short story " * 20, more="long " * 10), "x"))
    rows.append((8, "http://other.example/8", page.format(n="s8", text="short story " * 20, more="long " * 10), "x"))
    rows += [(9, None, None, "x"), (10, "not a url", "plain", "x"), (10, "not a url", "plain", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_main.extract(df).collect()
    by_id = {r.page_id: r for r in found}
    assert len(found) == len(rows)
    assert by_id[0].text == "Head s0\n" + ("story 0 " * 30).strip()
    assert by_id[7].text == "Head s7\n" + ("short story " * 20).strip() and by_id[8].text == ("short story " * 20).strip()
    assert by_id[9].text == "" and by_id[10].text == "plain"
    assert html_main.extract(df.limit(0)).collect() == []


def test_page_query_is_the_article(table, result):
    import html as entities
    import re

    found = result("op10_main_text").set_index("page_id")
    pages = table("pages").toPandas()
    assert len(found) == len(pages)
    for row in pages.itertuples():
        article = row.html.partition("<article>")[2].partition("</article>")[0]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>|<br>", "\0", article)).split("\0")
        lines = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert found.loc[row.page_id].text == "\n".join(x for x in lines if x)
        assert found.loc[row.page_id].n_chars == len(found.loc[row.page_id].text)


def test_joins_of_staged_names_are_not_broadcast(spark, rows_of):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    draw = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(draw.normal(size=(60, 4)))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    docs = spark.createDataFrame([(i, f"some words of text {i % 7}") for i in range(20)], "doc_id long, text string")
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long")
    fps = spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp long")
    assert sorted(rows_of(components.components(edges), "node", "component")) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
    for found in (
        va_search.top_k(df, lambda i: i % 10 == 0, 4), forest.near_vectors(df), simhash.near_duplicates(docs),
        simhash.near_links(fps), components._small_star(components._large_star(edges)),
    ):
        assert "Join" in plan(found) and "Broadcast" not in plan(found)


def test_tiles_grow_with_the_table(spark, rows_of, monkeypatch):
    # Copies of blocks for their meeting: pairs of blocks over the edge; four times the pairs come with twice the rows.
    copies = [p // va_search.tile_edge(p) for p in (1 << 16, 1 << 18, 1 << 20, 1 << 22)]
    assert all(b <= 2 * a for a, b in zip(copies, copies[1:]))
    assert va_search.tile_edge(0) == 1 and va_search.tile_edge(1 << 40) == va_search.TILE
    monkeypatch.setattr(va_search, "TILES", 4)
    draw = np.random.default_rng(6)
    vectors = [[float(x) for x in v] for v in draw.integers(-9, 10, (300, 5)) / 8] + [[1.0, 2.0]] * 7
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = va_search.top_k(df, lambda i: i % 10 == 0, 4, block=40, query_block=5)
    cut = [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in enumerate(vectors)]
    wanted = brute_top(cut[:300], 4, 10) + brute_top(cut[300:], 4, 10)
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)
