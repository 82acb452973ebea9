"""Personal data: pattern spans and information-theoretic sanitisation.

Patterns find emails, IP addresses, card and phone numbers.  Each distinct
value found is a protected entity.  Terms near an entity may give it away even
after it is masked, so the corpus is asked how strongly each does: with n(e, t)
documents that have term t within ``WINDOW`` words of entity e, n(e), n(t) and N
documents in all,

    disclosure = PMI(e, t) / IC(e) = log(N n(e, t) / (n(e) n(t))) / log(N / n(e))

is the share of the entity's information content that the term reveals (Sanchez
and Batet, "C-sanitized", 2016).  Every observed pair is judged, whether one
document holds it or many: from ``REMOVE`` on the term is removed, from
``GENERALISE`` on it is generalised, wherever it stands near that entity.  For an
entity of one document this asks how rare the term is in all documents.

The texts are read twice: once for the patterns and the contexts, once to count
candidate terms over all documents.  A fixed-size bitmap of the candidates'
hashes keeps other words from being counted; what it lets through wrongly, an
exact join removes.  Only counts and contexts are shuffled, never a text; keys
that more than one of ``HOT`` documents holds are joined by broadcast.

Defined cases: a null text counts as empty and has no spans; overlapping
patterns of different kinds are all reported; a context term never overlaps a
pattern span; rows are told apart by id and text, so repeated rows get equal
spans; an entity that every document holds reveals nothing; an empty table gives
an empty result; other columns are not read (``sanitise`` keeps them all)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainwatch.llm._common import HOT, joined, text_slices, unused, with_text_columns, written

#: Kinds of pattern spans, in the order of equal starts; actions on terms follow.
KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("generalise", "remove")
#: The patterns (fixed values of the contract).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP_PART, IP_RUN = re.compile("[0-9]+"), re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Words of context on either side, however long they are.
WINDOW = 8
#: Letters that a context term has at least.
LEAST_LETTERS = 3
#: Texts that a judged pair has at least: all pairs are; thresholds of the actions.
SUPPORT, GENERALISE, REMOVE = 1, 0.75, 0.9
#: Bits of the candidate bitmap.
BITS = 1 << 20

TERM = re.compile("[A-Za-z0-9\u0080-\U0010ffff]+")


def _byte_map() -> bytes:
    """The same words as TERM, on UTF-8 bytes: lower case, other bytes become spaces."""
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ips(text: str):
    """Spans of the ip pattern, four parts of digits: in a run of dotted parts, its
    leftmost matches are the parts taken four at a time."""
    for run in IP_RUN.finditer(text):
        if run.group().count(".") >= 3:
            parts = [m.span() for m in IP_PART.finditer(text, *run.span())]
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                values = [text[a:b].lstrip("0") for a, b in four]
                if all(len(v) <= 3 and int(v or "0") <= 255 for v in values):
                    yield four[0][0], four[3][1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of all pattern matches that pass their check,
    by start and kind; code points, end exclusive.  Each pattern takes time in
    proportion to the text, whatever it holds."""
    found, past = [], 0
    at = text.find("@")
    while at >= 0:
        # the leftmost match: all local characters before the sign, after the last match
        begin = at
        while begin > past and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, domain.end(), 0))
            past = domain.end()
        at = text.find("@", max(at + 1, past))
    if re.search("[0-9]", text):
        found += [(a, b, 1) for a, b in _ips(text)]
        for m in CARD.finditer(text):
            if 14 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
                found.append((*m.span(), 2))
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) >> 1


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of the terms near each span."""
    out = []
    words = [m.span() for m in TERM.finditer(text)]
    begins, ends = [a for a, _ in words], [b for _, b in words]
    starts, reach = [a for a, _, _ in spans], list(accumulate((b for _, b, _ in spans), max))

    def masked(a, b):  # some span begins before b and reaches beyond a
        k = bisect_left(starts, b)
        return k > 0 and reach[k - 1] > a

    for start, end, kind in spans:
        value = text[start:end]
        entity = _hash(f"{KINDS[kind]}:{_digits(value) if kind > 1 else value.lower()}".encode())
        before, after = bisect_right(ends, start), bisect_left(begins, end)
        for a, b in words[max(0, before - WINDOW) : before] + words[after : after + WINDOW]:
            word = text[a:b]
            if sum(c.isalpha() for c in word) >= LEAST_LETTERS and not masked(a, b):
                out.append((entity, _hash(word.encode().translate(_MAP)), a, b))
    return out


_MAP = _byte_map()
SPAN = "struct<start:bigint,end:bigint,kind:int>"
CONTEXT = "struct<entity:bigint,term:bigint,start:bigint,end:bigint>"


def find_base(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, base, context): row tells id and text apart."""
    fields = [
        T.StructField("text_key", T.LongType(), False),
        T.StructField("base", T._parse_datatype_string(f"array<{SPAN}>"), False),
        T.StructField("context", T._parse_datatype_string(f"array<{CONTEXT}>"), False),
    ]

    def make():
        def compute(texts):
            keys, base, context = [], [], []
            for t in texts:
                t = t or ""
                spans = base_spans(t)
                keys.append(_hash(t.encode()))
                base.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
                context.append([dict(zip(("entity", "term", "start", "end"), c)) for c in contexts(t, spans)] if spans else [])
            return keys, base, context

        return compute

    found = with_text_columns(docs.select(id, text), text, make, fields)
    return found.select(id, "text_key", F.xxhash64(id, "text_key").alias("row"), "base", "context")


def _bitmap(candidates: DataFrame) -> np.ndarray:
    """BITS flags of the candidates' terms, as at most BITS / 32 rows."""
    place = F.pmod("term", F.lit(BITS))
    word = F.expr(f"shiftleft(1L, cast(pmod(term, {BITS}) % 32 as int))")
    rows = candidates.groupBy((place / 32).cast("int").alias("at")).agg(F.bit_or(word).alias("bits")).collect()
    words = np.zeros(BITS // 32, np.uint32)
    for r in rows:
        words[r["at"]] = r.bits
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def term_counts(docs: DataFrame, text: str, flags: np.ndarray) -> DataFrame:
    """(term, n): documents that hold each flagged term, summed per task."""
    packed = np.packbits(flags).tobytes()

    def run(batches):
        live = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        known: dict[bytes, int] = {}
        counts: dict[int, int] = {}
        for whole in batches:
            for b in text_slices(whole, text):
                for t in b.column(text).to_pylist():
                    for w in set((t or "").encode().translate(_MAP).split()):
                        h = known.get(w)
                        if h is None:
                            if len(known) > 300_000:
                                known.clear()
                            h = _hash(w)
                            h = known[w] = h if live[h % BITS] else -1
                        if h >= 0:
                            counts[h] = counts.get(h, 0) + 1
                if len(counts) > 300_000:
                    yield _counts(counts)
                    counts = {}
        yield _counts(counts)

    def _counts(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return docs.select(text).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosures(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(entity, term, disclosure, action, frequent) of the pairs above the thresholds."""
    near = found.select("row", F.inline("context")).select("row", "entity", "term")
    # documents of each pair; one row a document and pair first
    pairs = written(near.distinct().groupBy("entity", "term").agg(F.count("*").alias("n_pair")), "pii-pairs")
    flags = _bitmap(pairs.select("term"))
    total = docs.count()
    frequent = lambda n: F.col(n) > total / HOT
    if not flags.any():
        return pairs.limit(0).select("entity", "term", F.lit(0.0).alias("disclosure"), F.lit(0).alias("action"), F.lit(False).alias("frequent"))
    entities = near.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    rated = joined(pairs, written(entities, "pii-entities"), ["entity"], frequent("n_entity"))
    rated = joined(rated, written(term_counts(docs, text, flags), "pii-terms"), ["term"], frequent("n_term"))
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log(F.lit(float(total)) * F.col("n_pair") / (F.col("n_entity") * F.col("n_term")))
    rated = rated.withColumn("disclosure", F.when(information > 0, mutual / information).otherwise(0.0))
    action = F.when(F.col("disclosure") >= REMOVE, len(KINDS) + 1).otherwise(len(KINDS))
    rated = rated.where(F.col("disclosure") >= GENERALISE)
    return rated.select("entity", "term", "disclosure", action.alias("action"), frequent("n_pair").alias("frequent"))


def find_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, text_key, base and spans, arrays of (start,
    end, kind) by start and kind; ``spans`` adds the terms that disclose."""
    found = written(find_base(docs, id, text), "pii-base")
    pairs = written(disclosures(docs, found, text), "pii-disclosures").select("entity", "term", "action", "frequent")
    near = found.select("row", F.inline("context"))
    near = joined(near, pairs, ["entity", "term"], F.col("frequent"))
    added = near.groupBy("row", "start", "end").agg(F.max("action").alias("kind"))
    span = F.struct(*(F.col(c).cast(k).alias(c) for c, k in (("start", "bigint"), ("end", "bigint"), ("kind", "int"))))
    added = added.groupBy("row").agg(F.collect_list(span).alias("added"))
    rows = found.drop("context").join(added, "row", "left")
    order = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    both = F.array_sort(F.transform(F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))), order))
    spans = F.transform(both, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select(id, "text_key", "base", spans.alias("spans"))


def span_text(column: str):
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS + ACTIONS))
    part = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(column, part), ",")


def sanitise(docs: DataFrame, spans: DataFrame, id: str = "doc_id", text: str = "text", out: str = "sanitised") -> DataFrame:
    """Append the text with pattern spans masked by their kind, generalised terms
    replaced by ``[TERM]`` and removed ones left out.

    ``spans`` is the result of :func:`find_spans` on the same documents; its
    texts' keys must be told apart by id only, so ids must be unique."""
    key, own = unused(docs, "_id"), unused(docs, "_spans")
    rows = docs.join(spans.select(F.col(id).alias(key), F.col("spans").alias(own)), docs[id].eqNullSafe(F.col(key)), "left").drop(key)

    def make():
        def compute(batch):
            return [[_masked(t, spans) for t, spans in batch]]

        return compute

    return with_text_columns(rows, text, make, [T.StructField(out, T.StringType(), True)], also=[own]).drop(own)


def _masked(text: str | None, spans: list | None) -> str | None:
    if text is None or not spans:
        return text
    out, past = [], 0
    for s in spans:
        if s["start"] < past:
            continue
        out.append(text[past : s["start"]])
        kind = s["kind"]
        out.append(f"[{KINDS[kind].upper()}]" if kind < len(KINDS) else "[TERM]" if kind == len(KINDS) else "")
        past = s["end"]
    return "".join(out) + text[past:]
