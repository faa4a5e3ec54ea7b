"""The pipeline stage by stage against plain Python on a small corpus, and its Kneser-Ney models against dictionaries."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from martforge.llm import language_id as li
from tests.llm.helpers import EMPTY, edit, odd_documents, prose
from tests.llm.test_mix_and_format import targets
from tests.llm.test_models_and_tokens import labelled
from tests.llm.test_ngram_join import brute
from tests.llm.test_scan_quality_shards import base_spans


class DictKN:
    """Interpolated Kneser-Ney with dictionaries, straight from the definition."""

    def __init__(self, texts, order, alphabet):
        self.order, self.alphabet = order, alphabet
        self.count = [None] + [Counter() for _ in range(order)]
        for t in texts:
            t = " " * (order - 1) + t
            for i in range(order - 1, len(t)):
                for k in range(1, order + 1):
                    self.count[k][t[i - k + 1:i + 1]] += 1
        for k in range(1, order):
            left = Counter(g[1:] for g in self.count[k + 1])
            self.count[k] = {g: left.get(g, 1) for g in self.count[k]}
        self.total, self.types, self.discount = {}, {}, {}
        for k in range(1, order + 1):
            self.total[k], self.types[k] = defaultdict(int), defaultdict(int)
            for g, c in self.count[k].items():
                self.total[k][g[:-1]] += c
                self.types[k][g[:-1]] += 1
            n1, n2 = (sum(c == x for c in self.count[k].values()) for x in (1, 2))
            self.discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def p(self, gram, k):
        if k == 0:
            return 1 / (self.alphabet + 1)
        gram = gram[-k:]
        lower, total = self.p(gram, k - 1), self.total[k].get(gram[:-1], 0)
        if not total:
            return lower
        d = self.discount[k]
        return (max(self.count[k].get(gram, 0) - d, 0) + d * self.types[k][gram[:-1]] * lower) / total

    def entropy(self, t):
        s = " " * (self.order - 1) + t
        return -sum(math.log(self.p(s[: i + 1], self.order)) for i in range(self.order - 1, len(s))) / len(t)


def normal(t):
    return "".join(chr(c) for c in li.letters_of(t).tolist())


def test_models_equal_dictionaries(spark):
    rows = labelled(5, 90)
    df = spark.createDataFrame(rows, "lang_no long, text string, lang string").select("lang", "text").repartition(3)
    table = li._gram_table(df, 3).toPandas()
    counts = {}
    for lang in sorted(set(table.lang)):
        per = [table[(table.lang == lang) & (table.k == k)] for k in (1, 2, 3)]
        counts[lang] = [{c: p[x].to_numpy().view(np.uint64) if c != "count" else p[x].to_numpy() for c, x in
                         (("gram", "gram"), ("suffix", "suffix"), ("context", "context"), ("count", "n"))} for p in per]
    m = li.build(3, counts)
    alphabet = len({c for _, t, _ in rows for c in normal(t)})
    plain = {lang: DictKN([normal(t) for _, t, x in rows if x == lang], 3, alphabet) for lang in m.langs}
    texts = [t for _, t, _ in labelled(6, 12)] + ["QQQ qq, ka!", "x"]
    got, _ = m.entropies(texts)
    want = [[plain[lang].entropy(normal(t)) for lang in m.langs] for t in texts]
    assert np.allclose(got, want, rtol=1e-4)


def corpus(spark):
    rng = random.Random(11)
    rows = []
    for i, t, lang in labelled(9, 160):
        if rng.random() < 0.5:
            t = t.replace(" ", ", ", 1) + "\nsecond line\tand more  " + t[::2]
        rows.append((i, t, lang, rng.choice(["s1", "s1", "s2", "s3", None])))
    for k in range(12):  # near copies
        rows.append((200 + k, edit(rng, rows[k][1] + " " + rows[k + 20][1] + " " + rows[k + 40][1], 0), rows[k][2], "s2"))
        rows.append((300 + k, edit(rng, rows[-1][1], 0.004), rows[k][2], "s1"))
    rows += [(400 + k, f"{rows[k][1]} token: abcd{k:04d}efgh {'secret=' + 'E' * 20}", rows[k][2], f"s{k % 3}") for k in range(60)]
    rows += [(500, None, "aa", "s1"), (501, "", "aa", None), (502, "123 !!", "aa", "s1"), (503, rows[0][1], "aa", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long"))


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    corpus(spark).repartition(4).write.parquet(f"{folder}/documents.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{len(kept)}"
        stage(spark, docs, folder).write.parquet(out)
        kept.append((docs, spark.read.parquet(out)))
        docs = kept[-1][1]
    assert all(a.columns == b.columns for a, b in kept[:-1])
    language, copies, secrets, mix, last = [(a.collect(), b.collect()) for a, b in kept]

    gone = {r.doc_id for r in language[0]} - {r.doc_id for r in language[1]}
    assert {500, 501, 502} <= gone and len(gone) <= 5

    first = {i for i, _, c in brute([(r.doc_id, r.text) for r in copies[0]], 5, 80) if i == c}
    assert {r.doc_id for r in copies[1]} == first and 503 not in first

    held = defaultdict(set)
    for r in secrets[0]:
        for start, kind, end in base_spans(r.text):
            m = re.fullmatch(r"(?is).*?[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r.text[start:end])
            held[m[1]].add((r.text, r.source))
    want = {}
    for r in secrets[0]:
        t = r.text
        for start, kind, end in reversed(base_spans(t)):
            value = re.fullmatch(r"(?is).*?[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t[start:end])[1]
            if min(len({s for _, s in held[value]}), len({x for x, _ in held[value]})) <= 2:
                t = t[:start] + "[SECRET]" + t[end:]
        want[r.doc_id] = (t, len(t))
    assert {r.doc_id: (r.text, r.n_chars) for r in secrets[1]} == want
    assert any("[SECRET]" in t for t, _ in want.values()) and any("EEEE" in t for t, _ in want.values())

    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mix[0]}
    per, taken = Counter(), Counter()
    for r in mix[0]:
        per[r.source] += size[r.doc_id]
    for r in mix[1]:
        taken[r.source] += size[r.doc_id]
    assert max(Counter(r.doc_id for r in mix[1]).values()) <= 2
    assert all(abs(taken[s] - t) <= 2 * max(size.values()) for s, t in targets(per).items())

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def encoded(t):
        ids = sp.encode(t, add_eos=True)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()

    assert Counter(map(tuple, last[1])) == Counter((r.doc_id, *encoded(r.text)) for r in last[0])
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == Counter(map(tuple, last[1]))


def test_stages_on_odd_rows_and_empty_tables(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and out.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    rng = random.Random(21)
    rows = []
    for k in range(30):
        text = prose(rng, rng.choice([4, 12, 40, 150]))
        rows += [(10 * k + j, edit(rng, text, share), "en", "s", 0) for j, share in enumerate((0, 0.01, 0.02, 0.03, 0.05))]
    df = spark.createDataFrame(rows, EMPTY).repartition(3)
    first, thin = ({i for i, _, c in brute([r[:2] for r in rows], *rule) if i == c} for rule in ((5, 80), (3, 90)))
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, df, "").collect()} == first
    assert len(first) < len(thin)


def test_secret_stage_counts_independent_holders(spark):
    own, mirrored, example = ("token: " + c * 20 for c in "qme")
    rows = [(k, f"document {k} of one source, {own}", "en", "s1", 0) for k in range(21)]
    rows += [(100 + k, f"one text in three sources, {mirrored}", "en", f"s{k}", 0) for k in range(3)]
    rows += [(200 + k, f"text {k}, {example}", "en", f"s{k}", 0) for k in range(3)]
    got = {r.doc_id: r.text for r in corpus_pipeline.secret_stage(spark, spark.createDataFrame(rows, EMPTY), "").collect()}
    assert all(("[SECRET]" in got[i]) == (i < 200) for i, *_ in rows) and len(got) == len(rows)
