import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from martforge.llm import embedding_forest as ef
from martforge.llm import language_id as li
from martforge.llm import token_frames
from martforge.llm.piece_encode import PieceModel, encode_decode
from martforge.llm.token_frames import ChunkEncoder, FrameReader, FrameWriter, read_token_frames, write_token_frames
from tests.llm.helpers import EMPTY, odd_documents, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
BITS = [" ", "  ", "\n", "\n\n", "\t", "a", "b", "the", "ing", "中", "é", "́", "\U0001f600", "▁", "'s", "'", "0", "12", "<0x41>", "</s>", "<|endoftext|>", "!!", ".", "\x00", "\r\n", "　", "\x1c", "\x85", "᠎", "İ"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "\n", "x" * 3000, "ab " * 3000]


def test_pieces_equal_the_library():
    m = PieceModel(PIECES)
    for t in random_texts(1, 4000):
        ids, said = m.encode(t)
        assert ids == m.library.encode(t, add_eos=True) and said == " ".join(map(str, ids))


def test_pieces_of_odd_rows(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = odd_documents(spark)

    def want(t):
        ids = sp.encode(t or "", add_eos=True)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()

    got = encode_decode(df, PIECES, with_ids=True).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == sorted(((r.doc_id, *want(r.text)) for r in df.collect()), key=str)
    assert encode_decode(spark.createDataFrame([], EMPTY), PIECES).collect() == []


def test_chunk_encoder_equals_the_library():
    from tokenizers import Tokenizer

    tk, e = Tokenizer.from_file(BYTES), ChunkEncoder(BYTES, remember=50)
    texts = random_texts(2, 4000)
    for k in range(0, len(texts), 16):
        for t, got in zip(texts[k: k + 16], e.encode(texts[k: k + 16], 2)):
            assert np.frombuffer(got, e.kind).tolist() == [*tk.encode(t, add_special_tokens=False).ids, 2]


def test_chunk_encoder_looks_up_each_chunk_once(monkeypatch):
    """Looking up every word cost as much as the library's calls (check of round 3: 490 CPU seconds a GB)."""
    from tokenizers import Tokenizer

    class Memo(dict):
        asked = 0

        def __getitem__(self, key):
            Memo.asked += 1
            return super().__getitem__(key)

    monkeypatch.setattr(token_frames, "LEARN", 7, raising=False)
    e, tk = ChunkEncoder(BYTES), Tokenizer.from_file(BYTES)
    e.young = Memo()
    words = [f"word{k}" for k in range(40)]
    texts = [" ".join(words[k:] + words[:k]) + "\nThe end." for k in range(40)] * 5
    got = e.encode(texts, 2)
    assert [np.frombuffer(x, e.kind).tolist() for x in got] == [[*tk.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert Memo.asked <= 2 * 40 + 3  # each after a blank and after a line break, and three in "The end."


def test_cuts_at_stops_equal_the_library():
    from tokenizers import Tokenizer

    tk, e = Tokenizer.from_file(BYTES), ChunkEncoder(BYTES, remember=300)
    assert len(e.written) > 400
    assert [e.written[c] for c in map(ord, " zé")] == ["Ġ", "z", "Ã©"]
    rng = random.Random(5)
    bits = [*"aZéßÿŁɏ×÷Ωя中̀", *",.;:!?", "'s", "'ll", "'", "&&&", "1", "22", "the", "Ing", "-", "\x00", "\n", " ", " ", " ", "\t"]
    texts = ["".join(rng.choices(bits[:-1] if k % 9 else bits, k=rng.randint(0, 40))).strip() for k in range(6000)]
    texts += [f"x{a}{b}y {a}{b} {b}{a}\n{a}x{b}" for a in bits[:-4] for b in bits[:-4]]
    for k in range(0, len(texts), 500):
        for t, got in zip(texts[k: k + 500], e.encode(texts[k: k + 500], 2), strict=True):
            assert np.frombuffer(got, e.kind).tolist() == [*tk.encode(t, add_special_tokens=False).ids, 2], t


def test_a_tokenizer_that_cuts_words_gets_no_words_past_it(tmp_path):
    from tokenizers import Tokenizer, normalizers

    tk = Tokenizer.from_file(BYTES)
    tk.normalizer = normalizers.Lowercase()
    tk.save(str(tmp_path / "t.json"))
    e, t = ChunkEncoder(str(tmp_path / "t.json")), "The Quick, BROWN fox.\nJumps É"
    assert e.written == {}
    assert np.frombuffer(e.encode([t], 2)[0], e.kind).tolist() == [*tk.encode(t, add_special_tokens=False).ids, 2]


def test_odd_texts_are_all_that_white_space_can_make():
    import pyarrow as pa
    import pyarrow.compute as pc

    e = ChunkEncoder(BYTES)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b" for c in chars] + [w.join(t) for w in (" ", "\n") for t in (("", "a"), ("a", ""), ("a", "", "b"), ("a", "b", "c"), ("", ""), ("a",), ("",))]
    texts += ["a \nb", "a\n b", "a b\nc", "a<|endoftext|>b", "a<|endoftext|b"]
    odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), f"{e._odd}|{e.uncut}").to_pylist()

    def plain(t):
        return bool(t) and t.split() == t.replace("\n", " ").split(" ") and not any(x in t for x in ("\u180e", "\uffff", "<|endoftext|>"))

    assert [t for t, o in zip(texts, odd, strict=True) if o == plain(t)] == []


def test_runs_are_bounded_and_whole():
    for sizes in ([], [0], [50], [1, 0, 2, 30, 9, 0, 1], [4] * 20):
        runs = list(token_frames._runs(sizes, 10))
        assert [x for a, b in runs for x in sizes[a:b]] == sizes
        assert all(sum(sizes[a + 1: b]) < 10 for a, b in runs)


def test_chunks_of_texts_with_odd_white_space_are_looked_up_once():
    from tokenizers import Tokenizer

    class Calls:
        def __init__(self, tk):
            self.tk, self.model, self.seen = tk, tk.model, []

        def encode(self, x, **how):
            self.seen += x if isinstance(x, list) else [x]
            return self.tk.encode(x, **how)

    e, tk = ChunkEncoder(BYTES), Tokenizer.from_file(BYTES)
    texts = [f"Same start here.\n\nAnd  some\tmore {k % 3}, end. " for k in range(60)] + ["中文" * 50_000 + "\t", " a", "a\uffffb c", "\uffff"]
    e.tokenizer = Calls(tk)
    got = e.encode(texts, 2)
    assert [np.frombuffer(x, e.kind).tolist() for x in got] == [[*tk.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert len(e.tokenizer.seen) == len(set(e.tokenizer.seen)) < 20 and not any(len(c) > e.longest for c in e.young)


def test_frames_read_only_what_is_asked(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 60_000, int(n)).astype("<u2") for n in rng.integers(0, 900, 60)]
    with open(tmp_path / "x.mft", "wb") as f:
        w = FrameWriter(f, 2, target=2000)
        for i, d in enumerate(docs):
            w.add(None if i < 2 else i * 10, d.tobytes())
        w.finish()
    raw = (tmp_path / "x.mft").read_bytes()
    with open(tmp_path / "x.mft", "rb") as f:
        r = FrameReader(f, len(raw))
        assert r.nulls == 2 and len(r.frames) > 5
        for k in (59, 0, 31, 30, 7):
            assert (r.ids(k) == docs[k]).all()
    broken = bytearray(raw)
    broken[int(r.starts[2]) + int(r.frames[2][0]) // 2] ^= 1
    (tmp_path / "y.mft").write_bytes(broken)
    with open(tmp_path / "y.mft", "rb") as f:
        y = FrameReader(f, len(broken))
        first = int(np.flatnonzero(y.docs["frame"] == 2)[0])
        assert (y.ids(0) == docs[0]).all() and (y.ids(59) == docs[59]).all()  # other frames are sound
        with pytest.raises(Exception):
            y.ids(first)


def test_token_files_of_odd_rows(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(BYTES)
    df = odd_documents(spark)
    got = read_token_frames(write_token_frames(df.repartition(5), BYTES, 2)).collect()
    want, start = [], 0
    rows = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    for i, t in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    assert read_token_frames(write_token_frames(spark.createDataFrame([], EMPTY), BYTES, 2)).collect() == []


def brute_links(ids, xs, least=0.95):
    ok = [x is not None and len(x) > 0 and all(c is not None and np.isfinite(c) for c in x) and any(x) for x in xs]
    links = set()
    for a in range(len(xs)):
        for b in range(a):
            if ok[a] and ok[b] and len(xs[a]) == len(xs[b]):
                p, q = np.array(xs[a], float), np.array(xs[b], float)
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= least:
                    links.add((b, a))
    comp = list(range(len(xs)))

    def find(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        comp[max(x, y, key=lambda k: ids[k])] = min(x, y, key=lambda k: ids[k])
    return {ids[k]: (sum(k in p for p in links), ids[find(k)]) for k in range(len(xs))}


def test_forest_finds_links(spark, monkeypatch):
    monkeypatch.setattr(ef, "BLOCK", 16)
    rng = np.random.default_rng(4)
    xs = []
    for size in (1, 1, 2, 3, 30, 60):
        c = rng.standard_normal(24)
        xs += [(c + rng.standard_normal(24) * 0.17).tolist() for _ in range(size)]
    xs += [xs[-1]] * 20 + [(np.array(xs[-1]) * 3).tolist()] + [rng.standard_normal(24).tolist() for _ in range(300)]
    ids = rng.permutation(len(xs)).tolist()
    df = spark.createDataFrame(list(zip(ids, xs)), "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r for r in ef.near_duplicates(df, leaf_rows=40).collect()}
    want = brute_links(ids, xs)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(g.n_links for g in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.97 * len(want)
    assert all(g.kept == (g.component_id == i) for i, g in got.items())


def test_forest_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    xs = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [inf, 1.0], [1.0, 1.0], [1.0, 1.0], [2.0, 2.0], [1.0, 1.0, 0.0], [1e-200, 1e-200], [-1.0, -1.0]]
    ids = [*range(10, 10 + len(xs))]
    rows = [(i, x, "clash") for i, x in zip(ids, xs)] + [(None, [1.0, 1.0], "clash")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in ef.near_duplicates(df).collect()}
    assert got == {**brute_links(ids, xs), None: (0, None)}
    assert ef.near_duplicates(df.limit(0)).collect() == []


def labelled(seed, n):
    rng = random.Random(seed)
    parts = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["sch", "ung", "ein", "über", "ze"], "cc": ["éa", "ou", "tion", "ment", "qu"]}
    out = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 80))), lang))
    return out


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame(labelled(1, 200), "doc_id long, text string, lang string")
    m = li.fit(df, F.col("doc_id"), F.col("text"), F.col("lang"), F.lit(True), order=3)
    letters = [c for t in df.select("text").collect() for c in t[0]]
    alphabet = sorted(set(letters))
    for before in ("ka", "un", "  ", "qq"):  # seen and unseen contexts
        p = np.array([np.exp(m.log_probabilities(np.array([ord(x) for x in before + c], np.uint64))[-1]) for c in alphabet]).sum(axis=0)
        assert (p <= 1.0001).all() and (p > 0.9).all()  # the rest is for unknown characters


def test_languages_of_held_out_texts(spark):
    rows = labelled(2, 600)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    m = li.fit(df, F.col("doc_id"), F.col("text"), F.col("lang"), ~li.held_out(F.col("doc_id")), fit_docs=100)
    out = li.identify(df.withColumn("lang", F.lit("hidden")), m, F.col("doc_id"), F.col("text")).withColumn("held", li.held_out(F.col("doc_id"))).collect()
    lang = {i: x for i, _, x in rows}
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held]
    assert len(held) > 80 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out) and sum(r.accepted for r in out) >= 0.98 * len(out)
    alien = spark.createDataFrame([(0, "zzz www xxx vvv jjj " * 20)], "doc_id long, text string")
    assert not li.identify(alien, m, F.col("doc_id"), F.col("text")).first().accepted


def test_entropy_of_long_texts_does_not_depend_on_blocks(spark, monkeypatch):
    df = spark.createDataFrame(labelled(3, 120), "doc_id long, text string, lang string")
    m = li.fit(df, F.col("doc_id"), F.col("text"), F.col("lang"), F.lit(True))
    texts = ["".join(labelled(4, 30)[k][1] for k in range(30)), "ka", None, "12", "lo mi"]
    whole, n = m.entropies(texts)
    monkeypatch.setattr(li, "_BLOCK_CHARS", 37)
    parts, _ = m.entropies(texts)
    assert np.allclose(whole[n > 0], parts[n > 0]) and (n == 0).tolist() == [False, False, True, True, False]


def test_language_odd_rows(spark):
    df = odd_documents(spark)
    m = li.fit(df, F.col("doc_id"), F.col("text"), F.col("lang"), F.lit(True))
    out = li.identify(df, m, F.col("doc_id"), F.col("text"), F.struct(*df.columns)).collect()
    assert len(out) == df.count()
    for r in out:
        has = any(c.isalpha() for c in r.kept_row.text or "")
        assert (r.lang_pred == "und") == (not has) and (has or (r.score, r.accepted) == (0, False))
    none = li.fit(df.limit(0), F.col("doc_id"), F.col("text"), F.col("lang"), F.lit(True))
    assert none.langs == [] and {r.lang_pred for r in li.identify(df, none, F.col("doc_id"), F.col("text")).collect()} == {"und"}
    assert li.identify(df.limit(0), m, F.col("doc_id"), F.col("text")).collect() == []


def test_long_prose_is_whole(spark):
    t = prose(random.Random(1), 20_000)
    m = PieceModel(PIECES)
    assert m.encode(t)[0] == m.library.encode(t, add_eos=True)


def test_words_of_one_part_are_remembered_once():
    m = PieceModel(PIECES)
    texts = ["plain words stand here and plain words stay", "naïve 漢字 mixed42 words", "x" * 100]
    for t in texts:
        ids, said = m.encode(t)
        assert ids == [*m.library.encode(t), m.end_id] and said == " ".join(map(str, ids))
    cut = {w for w in m.words if all(("▁" + w)[k: k + 2] in m.joined for k in range(len(w)))}
    assert {"plain", "words"} <= cut and not any("▁" + w in m.memo for w in cut)
