"""Spelling groups, lexical search and nearest neighbours against brute force and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import lexical_search as lx
from martforge.llm import spelling_groups as sg
from martforge.llm import vantage_search as vs
from martforge.llm.common import ship
from tests.llm.helpers import EMPTY, odd_documents, prose


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# -- spelling groups


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(counts, factor=10):
    near = {w: [x for x in counts if abs(len(x) - len(w)) <= 1 and x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None) for w in counts}


@pytest.mark.parametrize("block", [3, 40, sg.BLOCK_WORDS])
def test_spelling_groups_equal_brute_force(spark, block):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(0, 7))) for _ in range(700)}
    words |= {"x" * 400, "x" * 401, "x" * 200 + "y" + "x" * 199, "Àx÷ÿ", "àx÷ÿ"}
    counts = {w: rng.choice([1, 2, 5, 20, 50, 100, 1000, 30_000]) for w in words}
    want = brute_groups(counts)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert {tuple(r) for r in sg.spelling_groups(df, block=block).collect()} == want
    assert any(f and f != r for _, f, r, *_ in want)  # chains of forms


def brute_tally(rows, shortest=7, least=2):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def test_variant_groups_of_texts(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeÉÀ×") for _ in range(rng.randint(5, 12))) for _ in range(25)]
    rows = [(k, " ".join(rng.choice(vocabulary).replace("a", rng.choice("aaaaaA")) for _ in range(rng.randint(0, 300))), "en", "s", 0) for k in range(60)]
    rows += [(None, "abcdefgh Abcdefgh", "en", "s", 0), (3, None, "en", "s", 0), (4, "straßenbahn1straßenbahn_ΩstraßenbahnΩ", "de", "s", 0)]
    docs = spark.createDataFrame(rows, EMPTY).repartition(4)
    got = {tuple(r) for r in sg.variant_groups(docs).collect()}
    assert got == brute_groups(brute_tally([r[:2] for r in rows]))
    in_parts = sg.tally(docs, sg.crc_deletion, hold=5).where("n > 1")
    assert {r.word: r.n for r in in_parts.collect()} == brute_tally([r[:2] for r in rows])
    assert any(f for _, f, *_ in got)


def test_spelling_groups_on_odd_rows(spark):
    docs = odd_documents(spark)
    got = {tuple(r) for r in sg.variant_groups(docs).collect()}
    assert got == brute_groups(brute_tally([(r.doc_id, r.text) for r in docs.collect()]))
    assert sg.variant_groups(spark.createDataFrame([], EMPTY)).count() == 0
    df = spark.createDataFrame([("aaa", 5, 1), ("aaa", 15, 1), ("aab", None, 1), (None, 3, 1), ("aaΩ", 900, 1), ("aa", 1, 1)], "word string, n long, form int")
    got = {r.word: tuple(r)[1:] for r in sg.spelling_groups(df).collect()}
    assert got == {"aaa": (None, "aaa", 20, 2, None), "aab": ("aaa", "aaa", 0, 2, 20), "aa": ("aaa", "aaa", 1, 2, 20),
                   None: (None, None, 3, 0, None), "aaΩ": (None, "aaΩ", 900, 0, None)}


# -- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_search(docs, items, k=50):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n, length = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in tf:
            m = 100 - 50 + 50 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEM = "item_id long, text string"


@pytest.mark.parametrize(("size", "k"), [(lx.AUTOMATON_BYTES, 7), (300, 50)])
def test_lexical_search_equals_brute_force(spark, size, k):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.choice([0, 1, 5, 60, 400])).replace(" ", rng.choice([" ", "  ", "\n", "-", "_", "."])), "en", "s", 0) for i in range(300)]
    docs += [(i, docs[0][1], "en", "s", 0) for i in range(400, 480)]  # equal scores
    docs += [(500, "ÀB-àb ÀB Ω1Ω", "en", "s", 0), (501, "àb", "en", "s", 0), (None, docs[1][1], "en", "s", 0), (502, None, "en", "s", 0)]
    items = [(i, prose(rng, rng.choice([1, 3, 30]))) for i in range(20)] + [(50, "Àb. Ω1Ω"), (51, None), (52, "?!"), (3, "alpha1 Beta2"), (None, "gamma3 eta4"), (53, "a")]
    got = lx.lexical_search(spark.createDataFrame(docs, EMPTY).repartition(5), spark.createDataFrame(items, ITEM), k, automaton_bytes=size)
    assert Counter(map(tuple, got.collect())) == brute_search([d[:2] for d in docs], items, k)


def test_terms_are_whole_and_share_boundaries():
    s = lx.Shard([(1, b"a"), (1, b"ab"), (2, b"b"), (2, "é".encode())])
    n, own, tf = s.counts("a ab a_a;B abé é".encode())
    assert (n, {s.terms[t].decode(): c for t, c in zip(own, tf, strict=True)}) == (7, {"a": 3, "ab": 1, "b": 1, "é": 1})


def test_lexical_search_on_odd_rows(spark):
    docs, items = odd_documents(spark), spark.createDataFrame([(1, "one two x"), (2, "w" * 50_000 + " alpha1"), (3, None)], ITEM)
    got = lx.lexical_search(docs, items)
    assert Counter(map(tuple, got.collect())) == brute_search([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert lx.lexical_search(docs.limit(0), items).count() == 0
    assert lx.lexical_search(docs, items.limit(0)).count() == 0


# -- nearest neighbours


def brute_nearest(rows, k):
    sound = [(i, tuple(map(float, x))) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    queries = {}
    for i, x in sound:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, x), x)
    out = Counter()
    for i, q in queries.items():
        far = sorted((float(vs.exact_distance(np.array([x]), np.array([q]))[0]), j) for j, x in sound if j != i and len(x) == len(q))
        out.update((i, r, j, d) for r, (d, j) in enumerate(far[:k], 1))
    return out


VEC = "vec_id long, embedding array<float>, label int"


def clustered(rng, n, dim, clusters, width=0.05):
    centres = rng.standard_normal((clusters, dim))
    return (centres[rng.integers(0, clusters, n)] + width * rng.standard_normal((n, dim))).astype(np.float32).tolist()


@pytest.mark.parametrize("shard_bytes", [4096, vs.SHARD_BYTES])
def test_nearest_is_exact_at_factor_one(spark, shard_bytes):
    rng = np.random.default_rng(2)
    rows = [(i, x, 0) for i, x in enumerate(clustered(rng, 1500, 8, 12) + rng.standard_normal((500, 8)).astype(np.float32).tolist())]
    rows += [(3000 + i, rows[100][1], 0) for i in range(120)] + [(5000 + i, [1.0, float(i)], 1) for i in range(6)] + [(6000, [1.0, 2.0, 3.0], 1)]
    rows += [(200, rows[7][1], 0), (200, rows[200][1], 0), (None, rows[5][1], 0), (7000, None, 0), (7100, [], 0), (7200, [0.0] * 8, 0),
             (7300, [1.0] * 7 + [None], 0), (7400, [float("nan")] * 8, 0), (7500, [float("inf")] * 8, 0)]
    df = spark.createDataFrame(rows, VEC).repartition(4)
    got = vs.nearest(df, F.col("vec_id") % 100 == 0, shard_bytes=shard_bytes, leaf_rows=16)
    assert Counter(map(tuple, got.collect())) == brute_nearest([r[:2] for r in rows], 10)


def test_relaxed_pruning_compares_less_and_finds_most():
    rng = np.random.default_rng(4)
    x = np.array(clustered(rng, 8000, 16, 40), float)
    q, own = x[::100], np.arange(0, 8000, 100)
    found, compared = {}, {}
    for factor in (1.0, 1.5, 3.0):
        s = vs.Search(x, np.arange(len(x)), q, own, np.full(len(q), np.inf), 10, factor)
        seen = []
        s.compare = lambda rows, who, s=s, seen=seen: (seen.append(len(rows) * len(who)), vs.Search.compare(s, rows, who))
        s.go(vs.grow(x, 64, 1), np.arange(len(q)))
        found[factor], compared[factor] = set(zip(s.held[0].tolist(), s.held[2].tolist(), strict=True)), sum(seen)
    recall = {f: len(found[f] & found[1.0]) / len(found[1.0]) for f in found}
    assert recall[1.5] >= 0.95 and recall[3.0] >= 0.9
    assert compared[3.0] < compared[1.5] < compared[1.0] < len(x) * len(q) / 3


def test_cells_left_out_hold_nothing_within_reach():
    rng = np.random.default_rng(6)
    x = np.array(clustered(rng, 4000, 6, 30), float)
    cells = vs.Cells(x[:400].tolist(), {6: len(x)}, 16_000, 1)
    home, q, reach = cells.home(x), x[::50], np.full(80, 0.4)
    assert len(set(home.tolist())) > 8
    some = 0
    for r, kept in enumerate(cells.within(q, reach, 1.0)):
        d = np.sqrt(((x - q[r]) ** 2).sum(axis=1))
        near = set(home[d <= reach[r]].tolist()) - {int(cells.home(q[r:r + 1])[0])}
        assert near <= set(kept)
        some += len(kept) < len(set(home.tolist())) - 1
    assert some


def test_nearest_on_odd_rows(spark):
    assert vs.nearest(spark.createDataFrame([], VEC), F.col("vec_id") % 100 == 0).count() == 0
    assert vs.nearest(spark.createDataFrame([(100, [1.0], 0), (200, None, 0)], VEC), F.col("vec_id") % 100 == 0).count() == 0
    clash = spark.createDataFrame([(100, [1.0, 0.0], 1, 2, "a"), (1, [1.0, 1.0], 1, 2, "a"), (2, [1.0, -1.0], 1, 2, "a")],
                                  "vec_id long, embedding array<double>, cell int, rank int, reach string")
    assert [tuple(r) for r in vs.nearest(clash, F.col("vec_id") % 100 == 0).orderBy("rank").collect()] == [(100, 1, 1, 1.0), (100, 2, 2, 1.0)]
    with pytest.raises(ValueError):
        vs.nearest(clash, F.col("vec_id") == 1, factor=0.5)
