"""Token-id files: independent zstandard frames with a trailing seek table.

Layout of a file (all integers little-endian):

* zstandard frames, each with the uint32 ids of some consecutive documents;
* a seek table in a skippable frame: one entry per frame (offset, compressed
  bytes, raw bytes, xxh64 of the raw bytes, first document, documents) and one
  per document (id, whether it is null, first token in the file, tokens), then a
  footer (frames, documents, tokens, xxh64 of the entries, magic number).

Between the parts, and at the end, stands an empty skippable frame, so the
whole file is a valid zstandard stream for any decoder.  A reader finds the
footer from the end of the file, checks the table, and decompresses only the
frames of the documents that it wants; each frame's checksum is verified.

Spark range-partitions the documents by id, sorts each partition and writes
its files through the text sink, whose line separator is the empty skippable
frame; so files are committed as Spark commits any output, on any file system,
and a lost executor's task is simply run again.  A file is closed after
``FILE_BYTES`` of ids and document entries: it then has as many rows as the sink
puts into one file, short ones are filled up with empty rows.

``_index`` beside the files (Parquet, one row per file) has each file's first and
last id and its tokens.  A reader that wants some ids loads only the files whose
range holds one of them, and in those decompresses only their frames.

Defined cases: a null text counts as empty and has only the end id; null ids
come first; documents with equal ids stand next to each other, ordered by
text; an empty table gives no documents; other columns are not written."""

from __future__ import annotations

import string
import struct
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chainwatch.llm._common import per_worker, text_slices, word_places
from chainwatch.llm.bpe import STABLE_BYTE, byte_chars

#: An empty zstandard skippable frame; every byte of it is ASCII.
GAP = b"P*M\x18\x00\x00\x00\x00"
#: Magic numbers: skippable frame of the seek table, footer.
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x5445_4B54
FRAME = np.dtype([("offset", "<u8"), ("packed", "<u8"), ("raw", "<u8"), ("xxh64", "<u8"), ("first", "<u8"), ("docs", "<u8")])
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("start", "<u8"), ("tokens", "<u8")])
FOOTER = "<QQQQI"
FOOTER_BYTES = struct.calcsize(FOOTER)
#: Raw bytes after which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 256 << 10
#: Raw bytes of ids and document entries after which a file is closed.
FILE_BYTES = 64 << 20
#: Marks that often stand at a word's end.
MARKS = ".,;:!?"
#: Split of a normalised text into words (the fixed pattern of the vocabulary file).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


#: Of a token, its id.
ID = attrgetter("id")

#: Words, and pieces of words, of a generation that a worker remembers; the one
#: before is kept beside it, so that frequent words are never learnt again.
CACHE_WORDS, CACHE_PIECES = 220_000, 100_000


class WordEncoder:
    """The tokenizers library's ids for a vocabulary that drops white space.

    No token crosses ASCII white space, so each distinct word is encoded once
    by the library's own normaliser and model and then remembered.  ASCII words
    are remembered in lower case, those of letters without the marks after them."""

    #: Words with these spaces beyond ASCII go through the library whole, as do special tokens.
    SPACES = ("\xa0", "\x85")

    def __init__(self, path: str):
        self.lib = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.lib.get_added_tokens_decoder().values())
        self.odd = tuple(x.encode() for x in (*self.SPACES, *self.special))
        self.pattern = regex.compile(WORDS)
        self.chars = byte_chars()
        self.short = [struct.Struct(f"<{n}I").pack for n in range(32)]  # bytes of so many ids
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_words, self.older_pieces = self.words, self.pieces

    def encode(self, texts) -> list[bytes]:
        """Packed little-endian uint32 ids of each text: the ids of the distinct words
        are looked up, and every place takes its word's by index."""
        words, which, begins = word_places(texts)
        keys, marks = self._parts(words)
        known = keys.dictionary.cast(pa.binary()).to_pylist()
        self._remember(known)
        packed = [*map(self.words.__getitem__, known), *map(self._piece, marks.dictionary.to_pylist())]
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        part = np.stack([keys.indices.to_numpy(), marks.indices.to_numpy() + len(known)], axis=1).ravel()
        pool, end = _gathered(np.frombuffer(b"".join(packed), "<u4"), size, part)
        pool, end = _gathered(pool, np.diff(end[1::2], prepend=0), which)
        ids = memoryview(pool.tobytes())
        cuts = (4 * np.r_[0, end][begins]).tolist()
        return [bytes(ids[x:y]) for x, y in zip(cuts, cuts[1:])]

    def _parts(self, words: pa.Array) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
        """The key of each word, and the marks after it that the key leaves out.
        A word that is not ASCII, or holds a special token in any case, is its own key."""
        own = pc.invert(pc.string_is_ascii(words))
        for token in self.special:
            own = pc.or_(own, pc.match_substring(words, token, ignore_case=True))
        low = pc.ascii_lower(words)
        body = pc.ascii_rtrim(low, characters=MARKS)
        letters = pc.and_not(pc.ascii_is_alpha(body), own)  # letters, and marks after them: one piece each
        keys = pc.if_else(letters, body, pc.if_else(own, words, low))
        marks = pc.if_else(letters, pc.ascii_ltrim(low, characters=string.ascii_lowercase), "")
        return keys.dictionary_encode(), marks.dictionary_encode()

    def _remember(self, known: list[bytes]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.older_words, self.words = self.words, {}
        if len(self.pieces) > CACHE_PIECES:
            self.older_pieces, self.pieces = self.pieces, {}
        new = [w for w in known if w not in self.words]
        older = self.older_words
        if older is not self.words:
            self.words.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in older]
        if new:
            self._learn(new)

    def _learn(self, new: list[bytes]) -> None:
        whole = b" ".join(new)
        odd = [x for x in self.odd if x in whole]
        stable = np.frombuffer(whole, np.uint8).max(initial=0) < STABLE_BYTE
        plain, accented = [], []
        for w in new:
            if w.isalpha():  # lower-case letters of ASCII
                self.words[w] = self._tokens(w.decode())
            elif w.isascii() and not (odd and any(x in w for x in odd)):
                plain.append(w)
            elif (stable or max(w) < STABLE_BYTE) and not (odd and any(x in w for x in odd)):
                accented.append(w)
            else:
                self.words[w] = _pack(self.lib.encode(w.decode(), add_special_tokens=False).ids)
        # ASCII words only need lower case; one call of the normaliser for the others
        if plain:
            self._split(plain, b" ".join(plain).lower().decode())
        if accented:
            self._split(accented, self.lib.normalizer.normalize_str(b" ".join(accented).decode()))

    def _split(self, words: list[bytes], text: str) -> None:
        """Ids of each word; ``text`` has them normalised, with spaces between."""
        made = text.split(" ")
        if len(made) != len(words):
            raise ValueError("a word was split at a character that is not ASCII white space")
        known, piece, findall = self.words, self._piece, self.pattern.findall
        for w, n in zip(words, made):
            body = n.rstrip(MARKS)
            if body.isalpha():  # letters, and marks after them: one piece each
                known[w] = piece(body) + piece(n[len(body) :]) if len(body) < len(n) else piece(body)
            else:
                known[w] = b"".join(map(piece, findall(n)))

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older_pieces.get(piece)
            if ids is None:
                ids = self._tokens(piece if piece.isascii() and piece.isalnum() else "".join(map(self.chars.__getitem__, piece.encode())))
            self.pieces[piece] = ids
        return ids

    def _tokens(self, mapped: str) -> bytes:
        ids = [*map(ID, self.lib.model.tokenize(mapped))]
        return self.short[len(ids)](*ids) if len(ids) < len(self.short) else _pack(ids)


def _gathered(pool: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pool`` has lists of the given sizes behind each other: the chosen lists
    behind each other, and where each of these ends."""
    count = size[which]
    end = np.cumsum(count)
    at = np.repeat((np.cumsum(size) - size)[which] - (end - count), count)
    at += np.arange(len(at))
    return pool[at], end


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class FrameWriter:
    """Turns documents, in order, into the rows (byte strings) of files; every
    file but the last has ``rows`` of them."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES):
        self.frame_bytes, self.file_bytes = frame_bytes, file_bytes
        self.rows = file_rows(frame_bytes, file_bytes)
        self.zstd = zstandard.ZstdCompressor(level=3)
        self._open()

    def _open(self) -> None:
        self.frames, self.entries, self.docs, self.held = [], [], [], []
        self.offset = self.tokens = self.first = self.size = self.bytes = 0

    def add(self, id: int | None, packed: bytes) -> list[bytes]:
        self.docs.append((id or 0, id is None, self.tokens, len(packed) // 4))
        self.tokens += len(packed) // 4
        self.held.append(packed)
        self.size += len(packed)
        self.bytes += len(packed) + DOC.itemsize
        full = self.bytes >= self.file_bytes
        if not full and self.size < self.frame_bytes:
            return []
        made = [self._close()]
        if full or len(self.frames) == self.rows - 1:
            made += [b""] * (self.rows - 1 - len(self.frames))
            made += self.finish()
        return made

    def _close(self) -> bytes:
        raw = b"".join(self.held)
        frame = self.zstd.compress(raw)
        self.frames.append((self.offset, len(frame), len(raw), xxhash.xxh64_intdigest(raw), self.first, len(self.held)))
        self.entries.append(np.array(self.docs, DOC).tobytes())
        self.offset += len(frame) + len(GAP)
        self.first += len(self.held)
        self.docs, self.held, self.size = [], [], 0
        return frame

    def finish(self) -> list[bytes]:
        """Last rows of the file; nothing if it holds no document."""
        rows = [self._close()] if self.held else []
        if not self.frames:
            return rows
        entries = np.array(self.frames, FRAME).tobytes() + b"".join(self.entries)
        footer = struct.pack(FOOTER, len(self.frames), self.first, self.tokens, xxhash.xxh64_intdigest(entries), FOOTER_MAGIC)
        body = entries + footer
        self._open()
        return [*rows, struct.pack("<II", TABLE_MAGIC, len(body)) + body]


def file_rows(frame_bytes: int, file_bytes: int) -> int:
    """Rows of a full file: its frames and the seek table."""
    return max(1, file_bytes // frame_bytes) + 1


class TokenFile:
    """Random access to the documents of one file, given its bytes."""

    def __init__(self, content):
        self.content = memoryview(content)
        end = len(self.content) - len(GAP)
        frames, docs, self.tokens, check, magic = struct.unpack(FOOTER, self.content[end - FOOTER_BYTES : end])
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        size = frames * FRAME.itemsize + docs * DOC.itemsize
        entries = self.content[end - FOOTER_BYTES - size : end - FOOTER_BYTES]
        if xxhash.xxh64_intdigest(entries) != check:
            raise ValueError("checksum of the seek table")
        self.frames = np.frombuffer(entries[: frames * FRAME.itemsize], FRAME)
        self.docs = np.frombuffer(entries[frames * FRAME.itemsize :], DOC)

    def frame(self, k: int) -> bytes:
        f = self.frames[k]
        raw = zstandard.ZstdDecompressor().decompress(self.content[int(f["offset"]) : int(f["offset"] + f["packed"])], max_output_size=int(f["raw"]))
        if len(raw) != f["raw"] or xxhash.xxh64_intdigest(raw) != f["xxh64"]:
            raise ValueError(f"checksum of frame {k}")
        return raw

    def read(self, wanted: set[int] | None = None):
        """(id, first token in the file, packed ids) of the documents, or of
        those with a wanted id; other frames are not decompressed."""
        for k in range(len(self.frames)):
            a = int(self.frames[k]["first"])
            docs = self.docs[a : a + int(self.frames[k]["docs"])]
            if wanted is not None and not any(not d["null"] and int(d["id"]) in wanted for d in docs):
                continue
            raw, base = self.frame(k), int(docs[0]["start"])
            for id, null, start, tokens in docs.tolist():
                if wanted is None or not null and id in wanted:
                    at = 4 * (start - base)
                    yield None if null else id, start, raw[at : at + 4 * tokens]


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = 1, id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Encode every text, append ``end_id`` and write the files, in id order, and their index."""
    ordered = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")
    end = _pack([end_id])

    def run(batches):
        encoder = per_worker(("word", vocabulary), lambda: WordEncoder(vocabulary))
        out = FrameWriter(frame_bytes, file_bytes)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                packed = encoder.encode(batch.column("text"))
                rows = [r for i, p in zip(batch.column("id").to_pylist(), packed) for r in out.add(i, p + end)]
                yield _rows(rows)
        yield _rows(out.finish())

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    made = ordered.mapInArrow(run, "value binary")
    made = made.select(F.col("value").cast("string")).write.option("lineSep", GAP.decode())
    made.option("maxRecordsPerFile", file_rows(frame_bytes, file_bytes)).text(path)
    _write_index(docs.sparkSession, path)


INDEX = "name string, part bigint, piece bigint, first_id bigint, last_id bigint, docs bigint, tokens bigint"


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths).where("length > 0")
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "content")


def _write_index(spark: SparkSession, path: str) -> None:
    def entries(batches):
        for b in batches:
            made = []
            for content in b.column("content"):
                f = TokenFile(content.as_buffer())
                ids = f.docs["id"][f.docs["null"] == 0]
                made.append((int(ids.min()), int(ids.max()), len(f.docs), f.tokens) if len(ids) else (None, None, len(f.docs), f.tokens))
            columns = [pa.array(c, pa.int64()) for c in zip(*made)] if made else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([b.column("name"), *columns], names=["name", "first_id", "last_id", "docs", "tokens"])

    made = _files(spark, path).mapInArrow(entries, "name string, first_id bigint, last_id bigint, docs bigint, tokens bigint")
    place = [F.regexp_extract("name", p, 1).cast("bigint").alias(n) for n, p in (("part", r"^part-(\d+)"), ("piece", r"-c(\d+)"))]
    made.select("name", *place, "first_id", "last_id", "docs", "tokens").write.parquet(f"{path}/_index")


def read(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it, over all files), ids
    (packed) of every document, or of those with a wanted id."""
    index = spark.read.schema(INDEX).parquet(f"{path}/_index")
    chosen = None if wanted is None else set(wanted)
    paths = path
    if wanted is not None:  # at most the files that hold a wanted id's range
        held = index.where(F.exists(F.array(*map(F.lit, chosen)).cast("array<bigint>"), lambda i: i.between(F.col("first_id"), F.col("last_id"))))
        paths = [f"{path}/{r.name}" for r in held.select("name").collect()]
        if not paths:
            return spark.createDataFrame([], "doc_id bigint, start bigint, ids binary")

    def documents(batches):
        for b in batches:
            for name, content in zip(b.column("name"), b.column("content")):
                held, size = [], 0
                for row in TokenFile(content.as_buffer()).read(chosen):
                    held.append(row)
                    size += len(row[2])
                    if size > 4 << 20:
                        yield _docs(name, held)
                        held, size = [], 0
                if held:
                    yield _docs(name, held)

    def _docs(name, held):
        ids, starts, packed = zip(*held)
        columns = [pa.array([name.as_py()] * len(ids)), pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["name", "doc_id", "at", "ids"])

    # one row per file: files are numbered in id order
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    base = index.select(F.col("name").alias("_name"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_base"))
    docs = _files(spark, paths).mapInArrow(documents, "name string, doc_id bigint, at bigint, ids binary")
    return docs.join(base, F.col("name") == F.col("_name")).select("doc_id", (F.col("_base") + F.col("at")).alias("start"), "ids")
