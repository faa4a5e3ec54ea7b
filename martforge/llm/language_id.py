"""Language ID by interpolated Kneser-Ney character models.

For every language the character n-grams of its learning texts are counted at the highest order;
lower orders use continuation counts (distinct characters before an n-gram), and every order has one
absolute discount. Probabilities interpolate all orders down to the uniform distribution. The n-grams
met in any language stand in one sorted array of hashes per order, with one column of values per
language; a text is scored by looking its n-grams up there, backing off where one is unknown. The
language with the lowest cross-entropy per character wins.

Rejection is calibrated on learning texts that were not counted: the sharpness of the score, and for
every language the cross-entropy above which a text is unlike all of them.

The classifier is fitted on a bounded sample of labelled rows: at most ``fit_docs`` whole texts per
language, those with the smallest digests, of which every tenth calibrates. Its tables therefore have a
bound that does not grow with the input, and go to the tasks. Every document is scored, whole.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import small_side, stored

UNKNOWN = "und"
_SPACE = 32
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_BLOCK_CHARS = 1 << 18  # characters scored together


@functools.cache
def _word_char() -> np.ndarray:
    """1 for letters, 2 for marks, else 0, by code point."""
    return np.array([{"L": 1, "M": 2}.get(unicodedata.category(chr(i))[0], 0) for i in range(sys.maxunicode + 1)], np.uint8)


def letters_of(text: str | None) -> np.ndarray:
    """Lower-case code points of a text; each run of other characters is one blank. Empty if it has no letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _word_char()[c]
    if not (kind == 1).any():
        return np.empty(0, np.uint32)
    word = kind > 0
    keep = word.copy()
    keep[1:] |= word[:-1]
    return np.where(word, c, np.uint32(_SPACE))[keep]


def padded(texts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each after order - 1 blanks, and the text of each character (-1: padding)."""
    pad = order - 1
    chars = np.full(sum(len(t) + pad for t in texts), _SPACE, np.uint64)
    owner = np.full(len(chars), -1, np.int32)
    at = 0
    for k, t in enumerate(texts):
        chars[at + pad: at + pad + len(t)] = t
        owner[at + pad: at + pad + len(t)] = k
        at += pad + len(t)
    return chars, owner


def grams(chars: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each character, for lengths 0 (zeros) to ``order``; the first ones run over the start."""
    out = [np.zeros(len(chars), np.uint64)]
    for k in range(order):
        moved = np.concatenate([np.full(min(k, len(chars)), _SPACE, np.uint64), chars[: len(chars) - k]])
        out.append(out[-1] + (moved + np.uint64(1)) * _STEP[k])
    return out


def _find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of hashes in a sorted array; -1 where absent."""
    if not len(sorted_hashes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == wanted, at, -1)


@dataclass
class Models:
    """Models of all languages. By order: sorted n-gram hashes, their log probabilities (n-gram x
    language), sorted context hashes, log back-off weights (context x language)."""

    order: int
    langs: list[str]
    hashes: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0
    sharpness: float = 20.0
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def log_probabilities(self, chars: np.ndarray) -> np.ndarray:
        """Log probability of each character after its predecessors, by language (rows: characters)."""
        g = grams(chars, self.order)
        before = [np.concatenate([x[:1], x[:-1]]) for x in g]
        return self._at(self.order, np.arange(len(chars)), g, before)

    def _at(self, k: int, rows: np.ndarray, g: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        if k == 0:
            return np.full((len(rows), len(self.langs)), self.floor, np.float32)
        place = _find(self.hashes[k - 1], g[k][rows])
        out = self.logp[k - 1][place]
        absent = np.flatnonzero(place < 0)
        if len(absent):
            lost = rows[absent]
            context = _find(self.contexts[k - 1], before[k - 1][lost])
            weight = np.where(context[:, None] >= 0, self.backoff[k - 1][context], np.float32(0))
            out[absent] = weight + self._at(k - 1, lost, g, before)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages; NaN without letters), and numbers of characters."""
        seqs = [letters_of(t) for t in texts]
        n = np.array([len(s) for s in seqs], np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        # Blocks of bounded size; a long text goes on in the next block after its last characters.
        piece, held, ids = [], 0, []
        pad = self.order - 1

        def flush() -> None:
            chars, owner = padded([p for p, _ in piece], self.order)
            lead = np.zeros(len(chars), bool)
            at = 0
            for p, skip in piece:
                lead[at + pad: at + pad + skip] = True
                at += pad + len(p)
            lp = self.log_probabilities(chars)
            use = (owner >= 0) & ~lead
            own = np.array(ids, np.int64)[owner[use]]
            for j in range(len(self.langs)):
                total[:, j] += np.bincount(own, weights=lp[use, j], minlength=len(texts))

        for i, s in enumerate(seqs):
            for a in range(0, len(s), _BLOCK_CHARS):
                skip = min(a, pad)
                piece.append((s[a - skip: a + _BLOCK_CHARS], skip))
                ids.append(i)
                held += len(piece[-1][0])
                if held >= _BLOCK_CHARS:
                    flush()
                    piece, held, ids = [], 0, []
        if piece:
            flush()
        with np.errstate(invalid="ignore"):
            return -total / n[:, None], n

    def posterior(self, entropy: np.ndarray) -> np.ndarray:
        z = -self.sharpness * entropy
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def build(order: int, counts: dict[str, list[dict[str, np.ndarray]]]) -> Models:
    """Models from n-gram tables: per language and order (1 to ``order``) arrays gram, suffix, context, count.

    suffix and context are the hashes of the n-gram without its first and without its last character.
    """
    langs = sorted(counts)
    m = Models(order, langs)
    alphabet = len(np.unique(np.concatenate([counts[x][0]["gram"] for x in langs])))
    m.floor = -float(np.log(alphabet + 1))
    lower_h, lower_p = np.zeros(1, np.uint64), np.full((1, len(langs)), 1 / (alphabet + 1))
    for k in range(1, order + 1):
        hashes, first = np.unique(np.concatenate([counts[x][k - 1]["gram"] for x in langs]), return_index=True)
        suffix = np.concatenate([counts[x][k - 1]["suffix"] for x in langs])[first]
        context = np.concatenate([counts[x][k - 1]["context"] for x in langs])[first]
        contexts, place = np.unique(context, return_inverse=True)
        direct, weight = np.zeros((len(hashes), len(langs))), np.ones((len(contexts), len(langs)))
        for j, x in enumerate(langs):
            t = counts[x][k - 1]
            if k == order:
                c = t["count"].astype(float)
            else:  # distinct characters before the n-gram
                up, n = np.unique(counts[x][k]["suffix"], return_counts=True)
                at = _find(up, t["gram"])
                c = np.where(at >= 0, n[at], 1).astype(float)
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            own = np.searchsorted(hashes, t["gram"])
            total = np.bincount(place[own], weights=c, minlength=len(contexts))
            types = np.bincount(place[own], minlength=len(contexts))
            seen = total > 0
            weight[seen, j] = discount * types[seen] / total[seen]
            direct[own, j] = (c - discount) / total[place[own]]
        p = direct + weight[place] * lower_p[np.searchsorted(lower_h, suffix)]
        m.hashes.append(hashes)
        m.logp.append(np.log(p).astype(np.float32))
        m.contexts.append(contexts)
        m.backoff.append(np.log(weight).astype(np.float32))
        lower_h, lower_p = hashes, p
    return m


def _gram_table(texts: DataFrame, order: int) -> DataFrame:
    """lang, k, gram, suffix, context, n: n-gram counts of ``texts`` (lang, text)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(letters_of(text))
            for lang, seqs in by_lang.items():
                chars, owner = padded(seqs, order)
                g = grams(chars, order)
                use = np.flatnonzero(owner >= 0)
                for k in range(1, order + 1):
                    h, first, n = np.unique(g[k][use], return_index=True, return_counts=True)
                    at = use[first]
                    cols = [pa.array(x.view(np.int64)) for x in (h, g[k - 1][at], g[k - 1][at - 1])]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(np.full(len(h), k, np.int32)), *cols, pa.array(n.astype(np.int64))],
                                                     ["lang", "k", "gram", "suffix", "context", "n"])

    rows = texts.mapInArrow(run, "lang string, k int, gram long, suffix long, context long, n long")
    return rows.groupBy("lang", "k", "gram").agg(F.first("suffix").alias("suffix"), F.first("context").alias("context"), F.sum("n").alias("n"))


def fit(docs: DataFrame, doc_id: Column, text: Column, lang: Column, learn: Column, order: int = 4, fit_docs: int = 600) -> Models:
    """Models of all languages among the rows that ``learn``.

    Rows with null id, text or lang are never learned from; texts without letters count nothing. The
    sample is at most ``fit_docs`` rows per language, and only n-gram tables of it reach the driver.
    """
    rows = docs.select(doc_id.alias("id"), text.alias("text"), lang.cast("string").alias("lang"), learn.alias("learn")).where("learn and id is not null and lang is not null and text is not null")
    # Only rows below a digest bound that leaves about three times the sample meet in the ranking: the bounds,
    # one row per language, go to the rows (sent along if counted small), so no language gathers in one task.
    light = rows.select("id", "lang").withColumn("digest", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    bound = light.groupBy("lang").agg((F.lit(3.0 * fit_docs * (1 << 40)) / F.count(F.lit(1))).alias("bound"))
    order_by = Window.partitionBy("lang").orderBy("digest", "id")
    bound = small_side(stored(bound, "language-bounds"), 64)
    chosen = (light.join(bound, "lang").where(F.col("digest") < F.col("bound"))
              .withColumn("no", F.row_number().over(order_by)).where(F.col("no") <= fit_docs).select("id", "lang", "no"))
    sample = stored(rows.join(small_side(stored(chosen, "language-sample"), 64), ["id", "lang"]).select("lang", "text", "no"), "language-texts")
    table = _gram_table(sample.where("no % 10 != 0").select("lang", "text"), order).toArrow()
    cols = {c: table.column(c).to_numpy() for c in ("lang", "k", "gram", "suffix", "context", "n")}
    counts: dict[str, list] = {}
    for x in sorted(set(cols["lang"].tolist())):
        of = [np.flatnonzero((cols["lang"] == x) & (cols["k"] == k)) for k in range(1, order + 1)]
        counts[x] = [{"gram": cols["gram"][i].view(np.uint64), "suffix": cols["suffix"][i].view(np.uint64), "context": cols["context"][i].view(np.uint64), "count": cols["n"][i]} for i in of]
    if not counts:
        return Models(order, [])
    models = build(order, counts)
    return calibrate(models, sample.where("no % 10 = 0").select("lang", "text"))


def calibrate(models: Models, texts: DataFrame, slack: float = 1.25) -> Models:
    """Sharpness by likelihood over texts that were not counted; limits from their own languages' entropies."""
    shared = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            e, n = shared.value.entropies(batch.column(1).to_pylist())
            ok = n > 0
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), pa.array(e[ok].tolist(), pa.list_(pa.float64()))], ["lang", "e"])

    rows = texts.mapInArrow(run, "lang string, e array<double>").where(F.col("lang").isin(models.langs)).collect()  # at most fit_docs / 10 a language
    models.limit = np.full(len(models.langs), -models.floor)
    if rows:
        e, own = np.array([r["e"] for r in rows]), np.array([models.langs.index(r["lang"]) for r in rows])

        def loss(s: float) -> float:
            models.sharpness = s
            return -float(np.log(np.maximum(models.posterior(e)[np.arange(len(own)), own], 1e-12)).mean())

        models.sharpness = min((5.0, 10.0, 20.0, 40.0, 80.0), key=loss)
        for j in set(own.tolist()):
            models.limit[j] = e[own == j, j].max() * slack
    return models


def identify(docs: DataFrame, models: Models, doc_id: Column, text: Column, keep: Column | None = None, least_score: float = 0.4) -> DataFrame:
    """Language of every whole text.

    Returns one row per row of ``docs``: doc_id, lang_pred, score (0 to 1), entropy (nats per character
    under the predicted language), accepted (score and entropy within the calibrated bounds) and, with
    ``keep``, that expression as ``kept_row``. Null texts and texts without a letter, and all texts if
    nothing was learned, are ``und`` with score 0, null entropy and not accepted. Ties go to the first
    language by code point. Repeated rows get a row each, an empty table gives none; only the given
    expressions are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    extra = [] if keep is None else [keep.alias("kept_row")]
    rows = docs.select(doc_id.alias("doc_id"), text.alias("_text"), *extra)
    kind, packed = rows.schema, keep is not None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = shared.value
        for big in batches:
            for a in range(0, big.num_rows, 512):
                batch = big.slice(a, 512)
                size = batch.num_rows
                lang, score, entropy, good = np.full(size, UNKNOWN, object), np.zeros(size), np.full(size, np.nan), np.zeros(size, bool)
                if m.langs:
                    e, n = m.entropies(batch.column(1).to_pylist())
                    has = np.flatnonzero(n > 0)
                    if len(has):
                        best = e[has].argmin(axis=1)
                        lang[has] = np.array(m.langs, object)[best]
                        entropy[has] = e[has, best]
                        score[has] = m.posterior(e[has])[np.arange(len(has)), best]
                        good[has] = (score[has] >= least_score) & (entropy[has] <= m.limit[best])
                told = [pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)), pa.array(good)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *told, *batch.columns[2:]], ["doc_id", "lang_pred", "score", "entropy", "accepted", *(["kept_row"] if packed else [])])

    schema = f"doc_id {kind['doc_id'].dataType.simpleString()}, lang_pred string, score double, entropy double, accepted boolean"
    schema += f", kept_row {kind['kept_row'].dataType.simpleString()}" if packed else ""
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))
