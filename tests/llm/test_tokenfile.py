"""Ids against the tokenizers library; files by round trip, random access and damage."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from chainwatch.llm import tokenfile
from chainwatch.session import work_path

from .conftest import EDGES
from .test_bpe import _odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def _want(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_encoder_equals_the_library(corpus, monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHE_WORDS", 50)
    tok, own = Tokenizer.from_file(PATH), tokenfile.WordEncoder(PATH)
    end = np.array([1], "<u4").tobytes()
    texts = [*EDGES, *_odd_texts(), "ΣΑΣ ΑΣ İI", "a\xa0b c\x85d", *(t for _, t, _ in corpus[0][:40])]
    for part in (texts[:50], texts[50:], texts[:20]):
        assert [p + end for p in own.encode(part)] == [_want(tok, t) for t in part]


def test_files_round_trip(spark, make_docs, corpus):
    rows = [(i, t) for i, t, _ in corpus[0][:80]] + [(1000 + i, t) for i, t in enumerate(EDGES)] + [(None, "no id"), (1000, "second")]
    path = work_path(spark, "test-token-files")
    tokenfile.write(make_docs(rows), PATH, path, frame_bytes=2000)
    got = tokenfile.read(spark, path).collect()
    tok, start = Tokenizer.from_file(PATH), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = []
    for i, t in order:
        want.append((i, start, _want(tok, t)))
        start += len(want[-1][2]) // 4
    assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in got), key=lambda r: r[1]) == want
    some = tokenfile.read(spark, path, wanted=[3, 1006]).collect()
    assert sorted((r.doc_id, zlib.crc32(r.ids)) for r in some) == sorted((i, zlib.crc32(p)) for i, _, p in want if i in (3, 1006))


def test_one_file(spark, make_docs):
    path = work_path(spark, "test-token-file")
    tokenfile.write(make_docs(["one two", "three " * 3000, "four"]).coalesce(1), PATH, path, frame_bytes=1000)
    names = [n for n in glob.glob(path.replace("file:", "") + "/part-*")]
    files = [tokenfile.TokenFile(open(n, "rb").read()) for n in names if open(n, "rb").read()]
    frames = [(f, k) for f in files for k in range(len(f.frames))]
    assert sum(int(f.frames[k]["docs"]) for f, k in frames) == 3
    # the whole file is a zstandard stream for any decoder
    for f in files:
        plain = zstandard.ZstdDecompressor().stream_reader(bytes(f.content), read_across_frames=True).read()
        assert plain == b"".join(f.frame(k) for k in range(len(f.frames)))
        opened = []
        whole, f.frame = f.frame, lambda k, g=f.frame: opened.append(k) or g(k)
        first = int(f.docs[0]["id"])
        assert [r[0] for r in f.read({first})] == [first] and len(opened) == 1
        f.frame = whole
        damaged = bytearray(f.content)
        damaged[int(f.frames[0]["offset"]) + 6] ^= 1
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(tokenfile.TokenFile(bytes(damaged)).read())
    with pytest.raises(ValueError):
        tokenfile.TokenFile(b"no seek table here, but long enough to hold a footer")


def test_files_are_bounded_and_skipped(spark, make_docs, corpus):
    """Full files have the same number of rows, ids go on over all of them, and some
    ids are read without the bytes of the other files."""
    rows = [(i, t) for i, t, _ in corpus[0][:120]] + [(5000 + i, "tiny") for i in range(300)] + [(9000, "long " * 20_000), (None, None)]
    path, tok = work_path(spark, "test-token-bounded"), Tokenizer.from_file(PATH)
    tokenfile.write(make_docs(rows).coalesce(1), PATH, path, frame_bytes=1000, file_bytes=6000)
    local = path.replace("file:", "")
    sizes = {n: len(b) for n in glob.glob(local + "/part-*") if (b := open(n, "rb").read())}
    files = [tokenfile.TokenFile(open(n, "rb").read()) for n in sizes]
    assert len(files) > 20
    for f in files:  # beyond the bound is only a file's last document
        raw = f.docs["tokens"] * 4 + tokenfile.DOC.itemsize
        assert raw[:-1].sum() < 6000 and len(f.frames) <= 6
    got, start = sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.start), 0
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        assert (r.doc_id, r.start, bytes(r.ids)) == (i, start, _want(tok, t))
        start += len(r.ids) // 4
    some = tokenfile.read(spark, path, wanted=[5100, 5101, 77_777])
    read = [n.split("/")[-1] for n in some.inputFiles() if "_index" not in n]
    assert sorted(r.doc_id for r in some.collect()) == [5100, 5101]
    assert 1 <= len(read) <= 2 and sum(s for n, s in sizes.items() if n.split("/")[-1] in read) < sum(sizes.values()) / 10
    assert tokenfile.read(spark, path, wanted=[77_777]).count() == tokenfile.read(spark, path, wanted=[]).count() == 0


def test_no_documents(spark, make_docs):
    path = work_path(spark, "test-token-none")
    tokenfile.write(make_docs([]), PATH, path)
    assert tokenfile.read(spark, path).count() == 0
