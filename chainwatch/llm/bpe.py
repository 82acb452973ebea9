"""Byte-level BPE encoding and decoding with a pair occurrence index.

Every partition is encoded in chunks of text.  The distinct pre-tokens of a
chunk that are not known yet are laid out in one symbol array; an index maps
each adjacent symbol pair that has a merge rule to all its positions.  Active
ranks are taken in ascending order; a rank is applied to all its positions at
once, and the lists of the neighbouring pairs that this changes are updated.
There is no shuffle: each task reads its rows and appends columns.

Defined cases: a null text counts as empty; an empty text has no tokens and
decodes to an empty text; the special token's string in a text becomes the
special id, as in the tokenizers library; rows are independent, so ties,
repeated rows and extra columns need no care."""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from chainwatch.llm._common import per_worker, with_text_columns

#: Split of a text into pre-tokens (fixed value of byte-level BPE vocabularies).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts whose UTF-8 bytes all lie below this one hold no character beyond U+053F;
#: up to there every Unicode version agrees on letters, numbers and spaces.
STABLE_BYTE = 0xD5
#: Pre-tokens that a worker remembers before it starts afresh, and bytes of text
#: that it splits and merges at a time.
CACHE_WORDS, SLICE_BYTES = 200_000, 1 << 20


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class PairIndexBPE:
    """Encoder and decoder for one ``tokenizers`` JSON file of a byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], byte_chars()
        self.width = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = self.left * self.width + self.right
        self.rank_of = np.argsort(key, kind="stable")
        self.keys = key[self.rank_of]
        self.byte_id = np.array([vocab[c] for c in chars], np.int64)
        byte_of = {c: b for b, c in enumerate(chars)}
        self.token_bytes = [b""] * self.width
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pretoken = regex.compile(PRETOKEN)
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        self.known: dict[str, bytes] = {}

    # -- encoding

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each symbol pair, -1 where there is no rule."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word, packed as little-endian uint32."""
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size)
        start = end - size
        after = np.arange(1, len(sym) + 1)
        after[end - 1] = -1
        before = np.arange(-1, len(sym) - 1)
        before[start] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self._ranks(sym[at], sym[after[at]])
            found = rank >= 0
            at, rank = at[found], rank[found]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, p in zip(rank[np.r_[0, cut]].tolist(), np.split(at, cut)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(p)

        add(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            # positions whose pair has changed since they were listed fall out
            live = (sym[at] == a) & (nxt >= 0) & (sym[nxt] == b)
            at, nxt = at[live], nxt[live]
            if a == b and len(at) > 1:  # in a run of equal symbols take every second pair
                joined = np.r_[False, at[1:] == nxt[:-1]]
                i = np.arange(len(at))
                first = np.maximum.accumulate(np.where(joined, 0, i))
                take = (i - first) % 2 == 0
                at, nxt = at[take], nxt[take]
            if not len(at):
                continue
            sym[at], sym[nxt] = self.made[r], -1
            beyond = after[nxt]
            after[at] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = at[inside]
            prior = before[at]
            add(np.unique(np.concatenate([prior[prior >= 0], at[inside]])))
        alive = sym >= 0
        ids = sym[alive].astype("<u4").tobytes()
        stop = 4 * np.cumsum(np.add.reduceat(alive, start, dtype=np.int64))
        begin = np.r_[0, stop[:-1]]
        return [ids[x:y] for x, y in zip(begin.tolist(), stop.tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        split = [self._pretokens(t) if t else [] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = {w for words in split for w in words} - self.known.keys() - self.special.keys()
        if new:
            new = list(new)
            self.known.update(zip(new, self.merge([w.encode() for w in new])))
        for w, i in self.special.items():
            self.known[w] = np.array([i], "<u4").tobytes()
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def _pretokens(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self._split(text)
        out: list[str] = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if text.isascii() or np.frombuffer(text.encode(), np.uint8).max() < STABLE_BYTE:
            return self.pretoken.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    # -- decoding

    def decode(self, packed: bytes) -> str:
        """Text of packed ids, special tokens included."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Append the token ids of ``text`` as packed little-endian uint32 and, if
    ``decoded`` names a column, the text decoded from those ids."""
    fields = [T.StructField(ids, T.BinaryType(), False)] + ([T.StructField(decoded, T.StringType(), False)] if decoded else [])

    def make():
        bpe = per_worker(("bpe", path), lambda: PairIndexBPE(path))

        def compute(texts):
            packed = bpe.encode(texts)
            return [pa.array(packed, pa.binary())] + ([pa.array([bpe.decode(p) for p in packed], pa.string())] if decoded else [])

        return compute

    return with_text_columns(df, text, make, fields, limit=SLICE_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append the text of packed ids (null counts as no ids)."""

    def make():
        bpe = per_worker(("bpe", path), lambda: PairIndexBPE(path))
        return lambda packed: [pa.array([bpe.decode(p or b"") for p in packed], pa.string())]

    return with_text_columns(df, ids, make, [T.StructField(decoded, T.StringType(), False)])
