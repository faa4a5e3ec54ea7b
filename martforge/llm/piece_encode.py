"""Exact BPE encoding for SentencePiece models of merge type, by backtracking.

A text is normalised as the model says (a leading blank, blanks as U+2581) and cut where no piece
of the vocabulary can reach across: two neighbouring characters that no piece holds side by side.
Each part is encoded from the left: an Aho-Corasick automaton gives all pieces at each place; the
longest is tried first; a piece may follow its predecessor only if the two, merged again from their
characters, come out as these same two pieces; places from which no way leads to the end are marked
in a bit field and never entered again. A sequence whose pieces are all reproduced by merging and
whose neighbours are all compatible is the merge result itself, because the merges inside a piece
happen in the same order with or without its neighbours, as long as none crosses a border.

Parts recur, so each Python worker remembers the ids of parts it has met, in two generations of
bounded size. Nothing else is kept; memory does not grow with the input.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame

BLANK = "▁"


class Memo(dict):
    """Answers of ``f`` for short strings, in two generations of at most ``most`` entries; what ``skip`` finds is not kept."""

    def __init__(self, f: Callable[[str], bytes], most: int, skip: re.Pattern | None = None, longest: int = 64) -> None:
        super().__init__()
        self.f, self.most, self.skip, self.longest, self.old = f, most, skip, longest, {}

    def __missing__(self, s: str) -> bytes:
        found = self.old.get(s)
        if found is None:
            found = self.f(s)
        if len(s) <= self.longest and not (self.skip and self.skip.search(s)):
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[s] = found
        return found


class PieceModel:
    """Vocabulary, automaton and pair checks of one model file."""

    def __init__(self, path: str, remember: int = 300_000) -> None:
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.library, self.library.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {i: sp.get_score(i) for i in plain}
        self.text = {i: p for p, i in self.ids.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end_id = sp.eos_id()
        self.said = [str(i) for i in range(n)]
        self.joined = {p[k: k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self._merge(p) == [p]:  # others cannot come out of merging
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        # A part: blanks and what follows up to the next blank or line break, if no piece crosses there.
        crossing = {b for a, b in self.joined if a != BLANK}
        lone = [c for c in "\n\t\r" if not any(c in p for p in self.ids)]
        stop = "".join(map(re.escape, lone))
        self.cut = BLANK not in crossing
        if not self.cut:
            self.parts = lambda s: [s]
        else:
            first = f"[{stop}]|" if lone else ""
            self.parts = re.compile(f"{first}{BLANK}*[^{BLANK}{stop}]+|{BLANK}+").findall
        # Words hold no blank; those with a line break are made of remembered parts and not remembered themselves.
        self.memo = Memo(self.part_ids, remember)
        self.words = Memo(self.word_ids, remember, re.compile(f"[{stop}]") if lone else None)

    def _merge(self, s: str) -> list[str]:
        """Merge neighbours by falling score, leftmost first on ties: the definition, for pieces and pairs only."""
        sym, nxt, prv = list(s), list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and nxt[i] < len(sym) and (k := self.ids.get(sym[i] + sym[nxt[i]])) is not None:
                heapq.heappush(heap, (-self.score[k], i, sym[i] + sym[nxt[i]]))

        for i in range(len(sym)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = nxt[i]
            if not sym[i] or j >= len(sym) or sym[i] + sym[j] != both:
                continue
            sym[i], sym[j], nxt[i] = both, "", nxt[j]
            if nxt[j] < len(sym):
                prv[nxt[j]] = i
            offer(prv[i])
            offer(i)
        return [x for x in sym if x]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces side by side survive merging."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            a, b = self.text[left], self.text[right]
            known = (a[-1] + b[0]) not in self.joined or self._merge(a + b) == [a, b]
            if len(self.pairs) >= 200_000:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def encode_part(self, s: str) -> list[int]:
        """Ids of one part."""
        n = len(s)
        ids = self.ids
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # pieces by place, shortest first
        for end, piece in self.automaton.iter(s):
            at[end - piece[0] + 1].append(piece)
        for i, c in enumerate(s):
            if c not in ids:  # bytes of a character outside the vocabulary; it merges with nothing
                at[i] = [(1, -1)]
        failed = bytearray(n // 8 + 1)  # bit i: no way leads from place i to the end
        way: list[tuple[int, int, int]] = []  # place, pieces left to try there, id in use
        pairs, before, i = self.pairs, -1, 0
        c = len(at[0])
        while i < n:
            while c:
                c -= 1
                length, k = at[i][c]
                j = i + length
                if failed[j >> 3] >> (j & 7) & 1:
                    continue
                if before < 0 or k < 0:
                    break
                fit = pairs.get((before, k))
                if fit or fit is None and self.fits(before, k):
                    break
            else:
                failed[i >> 3] |= 1 << (i & 7)
                i, c, _ = way.pop()
                before = way[-1][2] if way else -1
                continue
            way.append((i, c, k))
            i, before = j, k
            c = len(at[i]) if i < n else 0
        out: list[int] = []
        for i, _, k in way:
            if k >= 0:
                out.append(k)
            else:
                out += [self.byte_ids[b] for b in s[i].encode()]
        return out

    def part_ids(self, s: str) -> bytes:
        """Ids of a part, as little-endian 32-bit integers: all that is remembered of it."""
        return np.array(self.encode_part(s), "<i4").tobytes()

    def word_ids(self, word: str) -> bytes:
        """Ids of a blank and a word without blanks that a blank or the end follows."""
        whole, joined, parts, begin = BLANK + word, self.joined, [], 0
        if self.cut:
            for k in range(1, len(whole)):
                if whole[k - 1: k + 1] not in joined:  # no piece reaches across
                    parts.append(whole[begin:k])
                    begin = k
        if not parts:  # one part: the word's entry holds it, a second one under the part would say the same
            return self.part_ids(whole)
        parts.append(whole[begin:])
        return b"".join(map(self.memo.__getitem__, parts))

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a text with the end id, and their decimal form joined by blanks."""
        if not text:
            found: list[bytes] = []
        elif self.cut and "  " not in text and text[0] != " " and text[-1] != " " and BLANK not in text:
            found = list(map(self.words.__getitem__, text.split(" ")))  # single blanks: every word is cut off on its own
        else:
            found = list(map(self.memo.__getitem__, self.parts(BLANK + text.replace(" ", BLANK))))
        ids = np.frombuffer(b"".join(found), "<i4").tolist()
        ids.append(self.end_id)
        return ids, " ".join(map(self.said.__getitem__, ids))


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a worker process, built once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each whole text with an end id and decode the ids again.

    Returns one row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    one blank), decoded_sha256 and, with ``with_ids``, ids (array of int) and decoded (the text from
    the library's decoder). A null text is empty: only the end id. Repeated rows give repeated rows;
    an empty table gives none; only the two columns are read. ``model_path`` must exist on every
    executor (the vocabulary files are installed there). No shuffle; rows stream through in Arrow
    batches.
    """
    import pyarrow as pa

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            n, ids_hex, text_hex, all_ids, decoded = [], [], [], [], []
            for t in batch.column(1).to_pylist():
                ids, said = m.encode(t or "")
                back = m.library.decode(ids)
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(said.encode()).hexdigest())
                text_hex.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    decoded.append(back)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(doc_id, text).mapInArrow(run, schema)
