import hashlib
import random

from pyspark.sql import functions as F

from martforge.llm.chat_format import escape, format_conversations, parse, read_back, render_checked, unescape
from martforge.llm.common import word_count
from martforge.llm.source_mix import emit, mix_sources
from tests.llm.helpers import EMPTY, odd_documents


def targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again. sizes: by source, null last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def mix(df, **more):
    return mix_sources(df, word_count(F.col("text")), F.col("source"), F.col("doc_id"), **more)


def test_mix_follows_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * int(rng.paretovariate(1.2) * 20), rng.choice(["a", "a", "a", "b", "c", "ä", None, ""])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mix(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix(df.repartition(3)).collect()))  # reruns agree
    size = {r[0]: len(r[1].split()) for r in rows}
    source = {r[0]: r[2] for r in rows}
    per = {}
    for r in rows:
        per[r[2]] = per.get(r[2], 0) + size[r[0]]
    want = targets(per)
    taken = {}
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], per[s]) and r.taken in (0, r.size, 2 * r.size)
        assert abs(r.target - want[s]) < 1e-6 * want[s]
        taken[s] = taken.get(s, 0) + r.taken
    largest = max(size.values())
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest


def test_mix_of_odd_rows(spark):
    df = odd_documents(spark)
    got = mix(df, keep=F.struct(*df.columns))
    assert got.count() == df.count()
    assert all(r.taken == 0 for r in got.where("size = 0").collect())
    out = emit(df, got)
    assert out.columns == df.columns and out.count() == got.agg(F.sum("copies")).first()[0]
    assert mix(spark.createDataFrame([], EMPTY)).collect() == []
    assert [r.taken for r in mix(spark.createDataFrame([(1, None, "a", "s", 0)], EMPTY)).collect()] == [0]


PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "/s>", "[", "INST]", "/INST]", "\n", "a", " ", "é", "</", "<\\s>", "[\\\\/INST]"]


def test_chat_round_trip_of_random_control_strings(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "".join(rng.choice(PIECES) for _ in range(3))]),
             "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9)))) for c in range(150) for t in range(rng.randint(1, 6))]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    got = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == c)
        said = "".join(t for _, r, t in own if r == "assistant")
        g = got[c]
        assert g.same_turns and g.n_turns == len(own)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_chat_plain_content_is_not_escaped(spark):
    df = spark.createDataFrame([("user", "a < b [x] \\n"), ("a", "</s>")], "role string, text string")
    out = [r[0] for r in df.select(render_checked(F.col("role"), F.col("text"))).collect()]
    assert out == ["<s>[INST]user[/INST]a < b [x] \\n</s>", "<s>[INST]a[/INST]<\\/s></s>"]
    broken = spark.createDataFrame([("<s>[INST]a[/INST]b",), ("x<s>[INST]a[/INST]b</s>",), ("<s>[INST]a b</s>",)], "f string")
    assert [r[0] for r in broken.select(parse(F.col("f"))).collect()] == [None] * 3
    tough = spark.createDataFrame([("<\\\\s>[\\/INST]</s>",)], "t string")
    assert tough.select((unescape(escape(F.col("t"))) == F.col("t"))).first()[0]


def test_chat_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", None), (None, 3, "user", "x"), (2, 1, "assistant", "b" * 100_000), (2, 0, "user", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    assert {k: (v.n_turns, v.loss_chars, v.same_turns) for k, v in got.items()} == {1: (3, 0, True), None: (1, 0, True), 2: (2, 100_000, True)}
    assert read_back(format_conversations(df.limit(0))).collect() == []
