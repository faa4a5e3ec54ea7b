"""Token-ID files of independent zstandard frames with a trailing seek table.

One file (shard) holds a run of documents in ascending doc_id order:

    data frame *              zstandard frames (no checksum of their own); each holds the ids of one
                              or more whole documents as little-endian unsigned integers of 2 or 4 bytes
    index frame               skippable frame 0x184D2A5D: "MFTI", version u8, id width u8, 2 bytes 0,
                              documents u64, documents with null doc_id u64 (they come first), then
                              per document: doc_id i64, ids u32, data frame u32
    seek table                skippable frame 0x184D2A5E in the public seekable format: per data frame
                              compressed size u32, decompressed size u32, low 32 bits of the XXH64 of
                              the decompressed bytes; footer: frames u32, descriptor 0x80, 0x8F92EAB1

Frames decompress alone, so a reader fetches the two tables at the end of a file and then only the
frames of the documents that it wants. Every frame's checksum is verified when it is read.

Writing: documents are dealt by doc_id ranges (the text is shuffled once), sorted, encoded and written
by the task of each range under a name of its own attempt, then renamed; a lost task writes the same
bytes again. A shard's first token needs the ids of earlier shards: tasks report their counts, one
row per shard, and the sums are given to the readers and kept in the manifest table.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import shared_path, stored

DATA_TARGET = 1 << 18  # ids in a data frame, at least, unless the shard ends
TEXT_TARGET = 1 << 23  # bytes of text encoded at once, and one document at most
LEARN = 1 << 16  # characters of new chunks in a call of the library, and one chunk at most
ENTRY = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("frame", "<u4")])
INDEX_MAGIC, SEEK_MAGIC, SEEK_FOOT = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1


class FrameWriter:
    """Writes one file. Documents go in one by one; only one frame is held."""

    def __init__(self, out, width: int = 2, level: int = 3, target: int = DATA_TARGET) -> None:
        import zstandard

        self.out, self.width, self.target = out, width, target
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs = array("q")  # doc_id, ids, frame; doc_id, ids, frame; ...
        self.nulls = 0
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Ids of one document, little-endian, ``width`` bytes each; documents without id first."""
        n = len(ids) // self.width
        self.nulls += doc_id is None
        self.docs.extend((doc_id or 0, n, len(self.frames)))
        self.tokens += n
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= self.target * self.width:
            self._flush()

    def _flush(self) -> None:
        import xxhash

        raw = b"".join(self.held)
        packed = self.zip.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.held_bytes = [], 0

    def finish(self) -> None:
        if self.held:
            self._flush()
        rows = np.frombuffer(self.docs, np.int64).reshape(-1, 3) if self.docs else np.zeros((0, 3), np.int64)
        docs = np.empty(len(rows), ENTRY)
        docs["doc_id"], docs["n"], docs["frame"] = rows.T
        index = b"MFTI" + struct.pack("<BBHQQ", 1, self.width, 0, len(docs), self.nulls) + docs.tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.frames, dtype="<u4").reshape(-1, 3).tobytes() + struct.pack("<IBI", len(self.frames), 0x80, SEEK_FOOT)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents of one file by their place; holds the tables and one frame."""

    def __init__(self, file, size: int) -> None:
        import zstandard

        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        foot = self._at(size - 9, 9)
        n, flags, magic = struct.unpack("<IBI", foot)
        if magic != SEEK_FOOT or not flags & 0x80:
            raise ValueError("no seek table")
        begin = size - 9 - 12 * n
        if struct.unpack("<II", self._at(begin - 8, 8)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError("broken seek table")
        self.frames = np.frombuffer(self._at(begin, 12 * n), "<u4").reshape(-1, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        index_at = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(index_at, 8))
        index = self._at(index_at + 8, length)
        version, self.width, _, docs, self.nulls = struct.unpack("<BBHQQ", index[4:24])
        if magic != INDEX_MAGIC or index[:4] != b"MFTI" or version != 1:
            raise ValueError("no document index")
        self.docs = np.frombuffer(index, ENTRY, count=docs, offset=24)
        before = np.concatenate([[0], np.cumsum(self.docs["n"], dtype=np.int64)])
        frame = self.docs["frame"].astype(np.int64)
        opens = np.searchsorted(frame, np.arange(n), side="left")  # first document of each frame
        self.inside = before[:-1] - before[opens[frame]] if docs else before[:-1]
        self.before = before
        self._frame, self._ids = -1, None

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        found = self.file.read(length)
        if len(found) != length:
            raise ValueError("file ends early")
        return found

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document; decompresses its frame alone."""
        import xxhash

        n, f = int(self.docs["n"][k]), int(self.docs["frame"][k])
        if f != self._frame:
            packed, length, check = (int(x) for x in self.frames[f])
            raw = self.unzip.decompress(self._at(int(self.starts[f]), packed), max_output_size=length)
            if len(raw) != length or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {f} is damaged")
            self._frame, self._ids = f, np.frombuffer(raw, f"<u{self.width}")
        at = int(self.inside[k])
        return self._ids[at: at + n]


def _runs(sizes, target: int) -> Iterator[tuple[int, int]]:
    """First and next row of runs with about ``target`` in all; a larger row begins its run."""
    run = np.cumsum(np.asarray(sizes, np.int64)) // target
    return pairwise([*np.flatnonzero(np.diff(run, prepend=-1)).tolist(), len(run)])


class ChunkEncoder:
    """Ids of whole texts from the tokenizers library, met chunks remembered.

    The byte-level pre-tokenizer never joins a blank that a visible character follows with what stands
    before it, nor a lone line break between visible characters with either side. Texts are cut there
    and the chunks go to the library as pre-tokenized input; the ids of a text are those of its chunks.
    A chunk is named by the word after its blank, or by its line break and the word after that. Texts
    with other white space are cut at blanks before visible characters only. Both are cut between a letter
    and a stop as well; a chunk without a blank before it is named by a tab and what follows. Chunks are
    numbered and the ids put together as Arrow columns, so only the distinct chunks of a call are looked
    up. A blank and letters are one pre-token, which goes to the library's model as the pre-tokenizer
    writes it. Texts with special strings, or U+FFFF, which marks the cuts, go to the library whole.
    ``remember`` bounds the chunks kept per generation.
    """

    _mark = "\uffff"
    _space = r"\t\x0B-\r\x1C-\x1F\x85\xA0\x{1680}\x{180E}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
    #: Texts whose white space is not single blanks and line breaks between visible characters (RE2).
    _odd = rf"^$|^[ \n]|[ \n]$|[ \n][ \n]|[{_space}]"
    _letters = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"

    def __init__(self, path: str, remember: int = 400_000, longest: int = 64) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.uncut = "|".join(map(re.escape, [self._mark, *self.special]))
        self.remember, self.longest, self.young, self.old = remember, longest, {}, {}
        self.skip = len(self._whole("\n"))
        self.written = self._written()
        self.lettered = re.compile(f"[{self._letters}]+").fullmatch

    def _written(self) -> dict[int, str]:
        """How the pre-tokenizer writes a blank and each letter inside a word; none if it cuts there."""
        found, write = {}, self.tokenizer.pre_tokenizer.pre_tokenize_str
        for x in " " + "".join(re.findall(f"[{self._letters}]", "".join(map(chr, range(0x250))))):
            cut = write(" a" if x == " " else f" a{x}a")
            if len(cut) != 1 or self.tokenizer.normalizer is not None:
                return {}
            found[ord(x)] = cut[0][0][:-1] if x == " " else cut[0][0][len(found[32]) + 1:-1]
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _keep(self, names: list[str], ids: list[int], counts) -> None:
        raw, begin = np.array(ids, self.kind).tobytes(), 0
        for c, end in zip(names, (np.cumsum(counts) * self.width).tolist(), strict=True):
            self.young[c] = raw[begin:end]
            begin = end

    def _learn(self, need: set[str]) -> list[str]:
        """Ids of new chunks, about ``LEARN`` characters at once; returns those too long to keep."""
        words, others = [], []
        for c in need:
            if (known := self.old.get(c)) is not None:
                self.young[c] = known
            elif self.written and self.lettered(c):
                words.append(c)
            else:
                others.append(c)
        tokenize = self.tokenizer.model.tokenize
        for a, b in _runs(list(map(len, words)), LEARN):
            new = words[a:b]
            found = [[t.id for t in tokenize((" " + c).translate(self.written))] for c in new]
            self._keep(new, list(chain.from_iterable(found)), [len(x) for x in found])
        for a, b in _runs(list(map(len, others)), LEARN):
            new = others[a:b]
            e = self.tokenizer.encode([c if c[0] == "\n" else c[1:] if c[0] == "\t" else " " + c for c in new], is_pretokenized=True, add_special_tokens=False)
            self._keep(new, e.ids, np.bincount(np.array(e.word_ids, np.int64), minlength=len(new)))
        return [c for c in chain(words, others) if len(c) > self.longest]

    def encode(self, texts, end_id: int) -> list[bytes]:
        """Ids of each text (a list or an Arrow array) and the end id, little-endian; a null is empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        kind, end = pa.large_string(), np.array([end_id], self.kind).tobytes()
        texts = pc.fill_null(pa.array(texts, kind) if isinstance(texts, list) else texts.cast(kind), "")
        uncut = pc.match_substring_regex(texts, self.uncut)
        odd = pc.and_not(pc.match_substring_regex(texts, self._odd), uncut)
        plain = pc.invert(pc.or_(uncut, odd))

        def after(first: str, x):
            return pc.binary_join_element_wise(pa.scalar(first, kind), x, pa.scalar("", kind))

        broken = pc.replace_substring(pc.replace_substring(texts.filter(plain), "\n", " \n"), " ", self._mark)
        spaced = pc.replace_substring_regex(texts.filter(odd), f" ([^ \\n{self._space}])", self._mark + "\\1")
        marked = pa.concat_arrays([after("\n", broken), after("\t", spaced)])
        stops = pc.replace_substring_regex(marked, f"([{self._letters}])([,.;:!?])", f"\\1{self._mark}\t\\2")
        chunks = pc.split_pattern(stops, self._mark)
        codes = chunks.flatten().dictionary_encode()
        names = codes.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long
        if len(self.young) >= self.remember:
            self.old, self.young = self.young, {}
        large = self._learn(set(names).difference(self.young))
        ids = pa.array(list(map(self.young.__getitem__, names)), pa.large_binary()).take(codes.indices)
        found = pc.binary_join(pa.ListArray.from_arrays(chunks.offsets, ids), pa.scalar(b"", ids.type)).to_pylist()
        for c in large:
            del self.young[c]
        out = [b""] * len(texts)
        at = [np.flatnonzero(x.to_numpy(zero_copy_only=False)).tolist() for x in (plain, odd, uncut)]
        for k, raw in zip(at[0], found[:len(broken)], strict=True):
            out[k] = raw[self.skip:] + end
        for k, raw in zip(at[1], found[len(broken):], strict=True):
            out[k] = raw + end
        for k in at[2]:
            out[k] = self._whole(texts[k].as_py()) + end
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of a worker process, built once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _filesystem(uri: str):
    """Arrow file system and path of a folder in the shared store."""
    from pyarrow import fs

    if uri.startswith("/") or uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def write_token_frames(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and write them as shards in ascending doc_id order.

    Returns the manifest, one row per shard: shard, path, n_docs, n_tokens, first_token (ids in earlier
    shards). A null text is empty (only the end id); null doc_ids come first; rows with equal doc_id are
    ordered by a digest of the text, equal rows follow each other; an empty table has an empty manifest.
    Only the two columns are read. doc_id must be an integer type.
    """
    folder = folder or shared_path(docs.sparkSession, "token-frames")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        store, root = _filesystem(folder)
        enc, w, n = encoder(tokenizer_path), None, 0
        final = f"{root}/shard-{shard:06d}.mft"
        own = f"{final}.{uuid.uuid4().hex}"
        out = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in _runs(pc.fill_null(pc.binary_length(texts), 0), TEXT_TARGET):
                if w is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(own)
                    w = FrameWriter(out, enc.width)
                for i, raw in zip(ids[a:b], enc.encode(texts.slice(a, b - a), end_id), strict=True):
                    w.add(i, raw)
                    n += 1
        if w is not None:
            w.finish()
            out.close()
            store.move(own, final)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [final], "n_docs": [n], "n_tokens": [w.tokens]},
                                             pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest = stored(dealt.mapInArrow(write, "shard int, path string, n_docs long, n_tokens long"), "token-manifest")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("folder", F.lit(folder)).withColumn("first_token", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")))


def read_token_frames(manifest: DataFrame, per_task: int = 1) -> DataFrame:
    """Read all shards back: doc_id, start (ids before the document in the whole corpus), n_tokens, ids_crc32.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers. Shards are
    dealt over the tasks; a task holds one frame at a time.
    """
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                store, _ = _filesystem(row["folder"])
                with store.open_input_file(row["path"]) as f:
                    r = FrameReader(f, f.size())
                    for a in range(0, len(r.docs), 10_000):
                        ks = range(a, min(a + 10_000, len(r.docs)))
                        crc = [zlib.crc32(r.ids(k).astype("<u4").tobytes()) for k in ks]
                        part = r.docs[a: a + 10_000]
                        null = np.arange(a, a + len(part)) < r.nulls
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part["doc_id"], pa.int64(), mask=null), pa.array(r.before[a: a + len(part)] + row["first_token"], pa.int64()),
                             pa.array(part["n"].astype(np.int64)), pa.array(crc, pa.int64())], schema=schema)

    spread = max(1, manifest.select(F.count(F.lit(1))).first()[0] // per_task)
    return (manifest.select("shard", "folder", "path", "first_token").repartition(spread, "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
