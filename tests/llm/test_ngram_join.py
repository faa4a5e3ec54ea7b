import random
import re

import numpy as np
import pytest

from martforge.llm import ngram_join as nj
from martforge.llm.components import components
from tests.llm.helpers import EMPTY, edit, odd_documents, prose


def brute(rows, width=3, percent=90):
    """component_id by row position, over all pairs."""
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())

    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def run(spark, rows):
    df = nj.ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_matches_brute_force_on_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(nj, "NODE_SETS", 8)
    monkeypatch.setattr(nj, "LEAF_SETS", 4)
    monkeypatch.setattr(nj, "SALT_SETS", 5)
    rng = random.Random(1)
    rows, k = [], 0
    for size in (12, 40, 120, 400):
        base = prose(rng, size)
        for _ in range(14):
            rows.append((k, edit(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04]))))
            k += 1
    for n in (1, 2, 3, 9, 10, 11, 12):  # smallest sets, one element apart
        w = [f"s{n}_{i}" for i in range(n + 2)]
        rows += [(k, " ".join(w)), (k + 1, " ".join(w[:-1])), (k + 2, " ".join(w[1:]))]
        k += 3
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    got = sorted((tuple(r) for r in nj.ngram_components(odd_documents(spark)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert nj.ngram_components(spark.createDataFrame([], EMPTY)).collect() == []


def test_repeated_id_ties_its_texts(spark):
    rng = random.Random(4)
    a, b = prose(rng, 60), prose(rng, 60)
    got = {(r.doc_id, r.component_id) for r in nj.ngram_components(spark.createDataFrame([(3, a), (7, a), (7, b), (9, b)], "doc_id long, text string")).collect()}
    assert got == {(3, 3), (7, 3), (9, 3)}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linking_sets_share_a_root(percent):
    import numpy as np

    rng = np.random.default_rng(percent)
    scheme = nj.Scheme(percent, 2)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        cut = int(rng.integers(0, max(1, n // 3) + 1))
        new = rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 3) + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([rng.permutation(a)[cut:], new]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert len(np.intersect1d(scheme.keys(a), scheme.keys(b))) > 0


def test_dual_walk_drops_only_hopeless_pairs():
    import numpy as np

    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64))
    sets = []
    for _ in range(150):
        keep = rng.random(len(base)) > rng.choice([0.01, 0.1, 0.3])
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**63, int(rng.integers(0, 8)), dtype=np.uint64)])))
    sets.sort(key=len)
    words = min(len(nj.bitmap(s)) for s in sets) // 8
    side = {"bits": np.stack([nj._fold(nj.bitmap(s), words) for s in sets]), "n": np.array([len(s) for s in sets]), "comp": np.arange(len(sets)) // 2}
    walked = {(int(a), int(b)) for i, j in nj.dual_walk(side, None, 90) for a, b in zip(i, j)}
    links = {(a, b) for b in range(len(sets)) for a in range(b) if a // 2 != b // 2
             and 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))}
    assert links and links <= walked and len(walked) < 0.7 * len(sets) ** 2 / 2


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_clashing_short_names_of_roots_lose_no_pair(spark):
    """Sets 0 and 1 meet under one root only; each has another root, and those two clash in 32 bits below its name."""
    from pyspark.sql import functions as F

    named = spark.range(300_000).select(F.xxhash64("id").alias("key")).withColumn("name", F.hash("key"))
    low, (k1, k2, *_) = min((r.name, r.k) for r in named.groupBy("name").agg(F.collect_set("key").alias("k")).where(F.size("k") > 1).collect())
    common = named.where(F.col("name") > low).agg(F.min("key")).first()[0]
    rng = random.Random(2)
    base = prose(rng, 200)
    texts = [(0, base), (1, base + " end"), (2, prose(rng, 200)), (3, prose(rng, 200))]
    placed = [(k1, 0), (k1, 2), (k2, 1), (k2, 3), (common, 0), (common, 1)]
    rows = spark.createDataFrame([(k, i, i) for k, i in placed], "key long, rep long, comp long")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    maps = nj.token_bitmaps(docs, docs.select("doc_id"), 3)
    assert {tuple(r) for r in nj.walk_roots(maps, rows, 90).collect()} == {(1, 0)}


@pytest.mark.parametrize(("chunk", "per_range"), [(60, 40), (1 << 19, 1 << 21)])
def test_roots_meet_across_chunks_and_ranges(spark, chunk, per_range):
    rng = random.Random(31)
    base = [prose(rng, n) for n in (12, 40, 90)]
    docs = [(i, edit(rng, base[i % 3], 0.02 * (i % 5))) for i in range(60)] + [(100, None), (101, "")]
    scheme = nj.Scheme(80)
    keys = {i: set(scheme.keys(nj.shingle_set(t, 3)).view(np.int64).tolist()) for i, t in docs}
    under = {}
    for i, own in keys.items():
        for k in own:
            under.setdefault(k, set()).add(i)
    want = {(k, i) for k, own in under.items() if len(own) > 1 for i in own}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = nj.meet_under_roots(df, scheme, 3, sum(map(len, keys.values())), chunk, per_range).collect()
    assert {(r.key, r.rep) for r in got} == want
    assert all(r.head in under[r.key] and r.n == len(nj.shingle_set(dict(docs)[r.rep], 3)) and r.head_n == len(nj.shingle_set(dict(docs)[r.head], 3)) for r in got)
    # What was tried connects all sets under a root.
    for k, own in under.items():
        if len(own) > 1:
            group = {i: i for i in own}
            for r in got:
                if r.key == k:
                    a, b = group[r.rep], group[r.head]
                    group = {i: min(a, b) if c in (a, b) else c for i, c in group.items()}
            assert len(set(group.values())) == 1
