"""Manifest, source mix and clusters against brute force on small fixtures with nulls, ties, repeated rows and extra columns."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import drift_clusters, manifest, source_mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, position int, row int, path string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Rows of (doc_id, source, lang, n_chars, text) with columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, lang, s, n, "t", 1, 2, "p") for i, s, lang, n, t in rows], SCHEMA)


def fixture(n, langs, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        doc = rng.choice([None, 7, i]) if i % 40 == 0 else i
        text = rng.choice([None, "", "Straße ÄÖ ABC x", " ".join(["Word"] * rng.randint(1, 300))])
        rows.append((doc, rng.choice(["hot"] * 6 + [None, "", "b", "é", f"tiny{i % 9}"]), rng.choice(langs), rng.choice([None, i]), text))
    return rows + rows[:3] + [(10**9, "long", langs[0], 1, "Very long " * 30_000)]


# -- manifest ----------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        yield i % 8, run[:i % 8] + run[i % 8 + 1:]
        i //= 8


def brute_manifest(rows):
    def leaf(values):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = collections.defaultdict(list)
    for r in rows:
        shown = leaf(r)
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            shown = leaf([*r[:4], r[4].translate(low)])
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), shown, r[0]))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: levels_over([t[2] for t in sorted(trees[x])]) if x is not None or trees[x] else [] for x in langs}
    crown = levels_over([built[x][-1][0] for x in langs])
    found = []
    for place, x in enumerate(langs):
        for i, t in enumerate(sorted(trees[x], key=lambda t: t[:4])):
            path = [*siblings(built[x], i), *siblings(crown, place)]
            node = t[3]
            for k, others in path:
                node = h(*others[:k], node, *others[k:])
            proof = h(*[o for _, others in path for o in others])
            found.append((t[4], t[2], built[x][-1][0], crown[-1][0], proof, node, node == crown[-1][0]))
    return collections.Counter(found)


def _sortable(rows):
    return [(10**6 + k if r[0] is None else r[0], *r[1:]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (9, [None]), (510, ["x"]), (513, ["x"]), (5000, ["en"] * 8 + [None, "", "de"])])
def test_manifest_equals_brute_force(spark, n, langs):
    rows = fixture(n, langs)[:-1] if n < 600 else fixture(n, langs)
    rows = _sortable(rows) if n > 600 else rows
    found = collections.Counter(tuple(r) for r in manifest.verify_documents(frame(spark, rows)).collect())
    assert found == brute_manifest(rows)


def test_many_small_trees_and_no_rows(spark):
    rows = [(i, None, f"l{i % 600:04d}", None, "X") for i in range(1300)]
    found = collections.Counter(tuple(r) for r in manifest.verify_documents(frame(spark, rows)).collect())
    assert found == brute_manifest(rows)
    assert manifest.verify_documents(frame(spark, [])).count() == 0
    assert manifest.prove(manifest.write_manifest(manifest.leaves(frame(spark, [])))).count() == 0


def test_proofs_of_some_leaves(spark):
    rows = _sortable(fixture(5000, ["en"] * 8 + [None, "de"]))
    made = manifest.write_manifest(manifest.leaves(frame(spark, rows)))
    assert [f.count() for f in made.levels[1:]][0] < 20  # only every third level is kept
    wanted = spark.createDataFrame([("=en", 0), ("=en", 3800), ("=de", 5), ("", 1), ("=de", 10**7), ("=en", 0)], "tree string, position long")
    found = manifest.prove(made, wanted).collect()
    assert {(r.tree, r.position) for r in found} == {("=en", 0), ("=en", 3800), ("=de", 5), ("", 1)} and len(found) == 4
    for r in found:
        path = [(p.place, p.others) for p in r.path]
        assert manifest.fold(r.leaf, path) == made.root == r.root
        assert manifest.fold(h("another"), path) != made.root
    every = manifest.prove(made)
    assert every.count() == len(rows) and every.columns == ["tree", "position", "doc_id", "leaf", "path", "subroot", "root"]


# -- mix ---------------------------------------------------------------------


def brute_mix(rows, weights=(1, 2, 3)):
    sizes = [len(WORD.findall(r[4] or "")) for r in rows]
    names = sorted({r[1] for r in rows}, key=lambda x: (x is None, x or ""))
    total = {n: sum(z for z, r in zip(sizes, rows) if r[1] == n) for n in names}
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    stopped, share = set(), Fraction(0)
    while len(stopped) < len(names):
        share = Fraction(sum(sizes) - sum(3 * total[n] for n in stopped), sum(weight[n] for n in names if n not in stopped))
        over = {n for n in names if n not in stopped and weight[n] * share > 3 * total[n]}
        if not over:
            break
        stopped |= over
    target = {n: 3 * total[n] if n in stopped else weight[n] * share for n in names}
    found = []
    for n in names:
        rounds, rest = divmod(min(round(float(target[n])), 3 * total[n]), total[n] or 1)
        mine = sorted((r[0] is not None, hashlib.md5(str(r[0]).encode()).hexdigest() if r[0] is not None else "", r[0] or 0, z, r[0] is None)
                      for r, z in zip(rows, sizes) if r[1] == n)
        at = 0
        for _, _, i, z, nameless in mine:
            found.append((None if nameless else i, z, total[n], round(float(target[n]), 6), rounds * z + max(0, min(at + z, rest) - at)))
            at += z
    return collections.Counter(found)


@pytest.mark.parametrize("block", [64, 2048])
def test_mix_equals_brute_force(spark, block):
    rows = fixture(1500, ["en"])
    found = source_mix.taken(frame(spark, rows), block_words=block).collect()
    assert collections.Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found) == brute_mix(rows)
    by_source = collections.Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        by_source[r.source_size, r.target] += r.taken
    assert all(abs(words - target) <= 0.5 for (_, target), words in by_source.items())


def test_mix_of_small_tables(spark):
    assert source_mix.taken(frame(spark, [])).count() == 0
    for rows in ([(1, None, "en", 1, None), (2, "a", "en", 1, "")], [(1, None, "en", 1, "one")], [(1, "a", None, 0, "a b c"), (2, "b", None, 0, "d")]):
        found = source_mix.taken(frame(spark, rows)).collect()
        assert collections.Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found) == brute_mix(rows)


def test_schedule_spreads_sources_and_takes_blocks_in_turn(spark):
    rows = fixture(1500, ["en"])
    mix = source_mix.plan(frame(spark, rows), block_words=64)
    slots = sorted(mix.slots.collect(), key=lambda r: r.slot)
    assert len({r.slot for r in slots}) == len(slots)
    whole = collections.Counter(r.tree for r in slots)
    for stretch in (200, 500, 1000):
        part = collections.Counter(r.tree for r in slots[:stretch])
        assert all(abs(part[t] - stretch * n / len(slots)) <= 12 for t, n in whole.items())
    sources = {r.tree: r for r in mix.sources.collect()}
    for tree in whole:
        own = [r for r in slots if r.tree == tree]
        blocks = -(-sources[tree]["size"] // 64)
        assert [(r.cycle, r.block) for r in own] == [divmod(k, blocks) for k in range(len(own))]
        assert sum(r.take for r in own) == sources[tree].quota
    filled = collections.defaultdict(list)
    for r in source_mix.pieces(mix, 64).collect():
        filled[r.slot].append((r.offset, r.words))
    for r in slots:  # the pieces of a slot join without a gap
        at = 0
        for offset, words in sorted(filled[r.slot]):
            assert offset == at
            at += words
        assert at == r["take"]


# -- clusters ----------------------------------------------------------------


def brute_clusters(rows, clusters=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    mark = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [np.array(v) for _, v in mark[:clusters]]
    vectors = np.array([v for _, v in kept])
    for k in range(rounds + 1):
        far = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centres], axis=1)
        own = far.argmin(axis=1)
        if k < rounds:
            centres = [vectors[own == c].sum(axis=0) // (own == c).sum() if (own == c).any() else x for c, x in enumerate(centres)]
    d = far.min(axis=1)
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return collections.Counter((i, int(own[k]), int(d[k]), int(d[own == own[k]].sum()), int(d.sum()), marks[own[k]]) for k, (i, _) in enumerate(kept))


def vectors_of(kind):
    rng = np.random.default_rng(1)
    plain = {"apart": lambda i: rng.normal(size=64) * .2 + i % 7, "together": lambda i: rng.normal(size=64), "tied": lambda i: np.round(rng.normal(size=64) * .02, 2)}
    rows = [(3 if i % 50 == 0 else i, [float(np.float32(x)) for x in plain[kind](i)]) for i in range(2000)]
    odd = [(1, None), (2, []), (3, [1.0] * 63), (4, [None] + [1.0] * 63), (5, [float("nan")] * 64), (6, [float("inf")] + [0.0] * 63), (None, [.5] * 64)]
    return rows + odd + rows[:4]


@pytest.mark.parametrize("kind", ["apart", "together", "tied"])
def test_clusters_equal_brute_force(spark, kind):
    rows = vectors_of(kind)
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, parts string, cluster int")
    found = drift_clusters.cluster(table).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert collections.Counter(tuple(r) for r in found) == brute_clusters(rows)


def test_clusters_of_small_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert drift_clusters.cluster(spark.createDataFrame([], kind)).count() == 0
    assert drift_clusters.cluster(spark.createDataFrame([(1, None), (2, [1.0])], kind)).count() == 0
    few = [(1, [0.0] * 64), (1, [0.0] * 64), (2, [1.0] * 64)]
    assert collections.Counter(tuple(r) for r in drift_clusters.cluster(spark.createDataFrame(few, kind)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()) == brute_clusters(few)


def test_bounds_save_distances_on_clusters_that_are_apart(spark):
    table = spark.createDataFrame([(i, v) for i, v in vectors_of("apart")], "vec_id long, embedding array<float>")
    found = drift_clusters.fit(drift_clusters.quantised(table))
    assert found.scanned[0] == 2005 * 16 and found.scanned[-1] < found.scanned[0] / 3


def test_gain_bounds_every_vector_of_the_sphere_and_is_less_than_the_way():
    rng = np.random.default_rng(7)
    tighter = 0
    for _ in range(300):
        old = rng.normal(size=(4, 6)) * rng.choice([1, 5, 20])
        new = old + rng.normal(size=(4, 6)) * rng.choice([.1, 1, 5])
        radius = np.abs(rng.normal(size=4)) * rng.choice([.1, 2])
        gain = drift_clusters.nearer_by(old, new, radius)
        way = np.sqrt(((new - old) ** 2).sum(axis=1))
        assert (gain <= way[None, :] + 1e-9).all()
        tighter += (gain < way[None, :] * .9).sum()
        for i in range(4):
            step = rng.normal(size=(200, 6))
            inside = old[i] + step / np.sqrt((step**2).sum(axis=1))[:, None] * radius[i] * rng.random((200, 1)) ** .2
            for j in range(4):
                came = np.sqrt(((inside - old[j]) ** 2).sum(axis=1)) - np.sqrt(((inside - new[j]) ** 2).sum(axis=1))
                assert came.max() <= gain[i, j] + 1e-9
    assert tighter > 1000
