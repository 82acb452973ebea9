"""Encoding against the tokenizers library itself; decoding as a round trip."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chainwatch.llm import bpe

from .conftest import EDGES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _want(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def _odd_texts():
    rnd = random.Random(4)
    pools = [(32, 127), (0x80, 0x540), (0x540, 0x3000), (0x3000, 0xD7FF), (0xE000, 0x1FFFF), (9, 33)]
    texts = ["".join(chr(rnd.randrange(*rnd.choice(pools))) for _ in range(120)) for _ in range(150)]
    runs = ["a" * n + "b" * n + "ab" * n for n in range(12)]
    return [*texts, *runs, "it's we'LL   they've\n\n x", "<|endoftext|><|endoftext|>", "x<|endoftext|> y"]


def test_encoder_equals_the_library(corpus):
    tok, own = Tokenizer.from_file(PATH), bpe.PairIndexBPE(PATH)
    texts = [*EDGES, *_odd_texts(), *(t for _, t, _ in corpus[0][:60])]
    got = own.encode(texts)
    assert [g for g in got] == [_want(tok, t) for t in texts]
    ids = [np.frombuffer(g, "<u4").tolist() for g in got]
    assert [own.decode(g) for g in got] == [tok.decode(i, skip_special_tokens=False) for i in ids]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    own = bpe.PairIndexBPE(PATH)
    texts = ["one two three four", "two five six", "one two", "seven one"]
    first = [own.encode([t])[0] for t in texts]
    assert first == bpe.PairIndexBPE(PATH).encode(texts)


def test_columns(make_docs):
    docs = make_docs(EDGES)
    back = bpe.encode(docs, PATH, decoded="decoded")
    assert back.columns == ["doc_id", "text", "lang", "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in back.collect())
    again = bpe.decode(bpe.encode(docs, PATH).drop("text"), PATH, decoded="text")
    assert all(r.text == (EDGES[r.doc_id] or "") for r in again.collect())
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    # a column with the name of a computed one is replaced
    assert bpe.encode(docs.withColumnRenamed("lang", "ids"), PATH).columns == ["doc_id", "text", "ids"]
