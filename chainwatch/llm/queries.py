"""The ``opN_*`` queries: each operator over the whole ``documents`` table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chainwatch.llm import (
    bpe, decontaminate, exact_dedup, langid, licenses, line_dedup, near_dedup, pii, quality, spelling, tokenfile, toxicity, whitening,
)
from chainwatch.llm._common import crc_bucket, read_table
from chainwatch.session import work_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket("doc_id", 5) == 0)
    seen = docs.where(~F.coalesce("held_out", F.lit(True)))
    languages = langid.fit(seen, sample=None)
    model = toxicity.fit(seen, read_table(spark, sf_dir, "labels"), languages)
    scored = toxicity.score(docs.select("doc_id", "held_out", "text"), model, languages)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_langid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket("doc_id", 4) == 2)
    model = langid.fit(docs.where(~F.coalesce("held_out", F.lit(True))))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "proportions", "rejected")


def op3_bpe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, BYTE_BPE, decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"))


def op5_licenses(spark, sf_dir):
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.inline("licenses"))


def op6_decontaminate(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


def op7_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (
  select doc_id, line, pos, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
o as (select key, min(doc_id) as owner from k where length(key) >= 10 group by key),
m as (select k.doc_id, k.line, k.pos, o.owner is null or o.owner = k.doc_id as stays from k left join o using (key))
select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (stays), '')) as kept_sha256
from m group by doc_id
"""


def op8_pii(spark, sf_dir):
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias("n_" + pii.KINDS[k])
    return found.select(
        "doc_id",
        *(count(k) for k in range(len(pii.KINDS))),
        F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


def op9_token_file(spark, sf_dir):
    path = work_path(spark, "token-files")
    tokenfile.write(read_table(spark, sf_dir, "documents"), WORD_BPE, path)
    return tokenfile.read(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, sha256(t) as text_sha256
from n window w as (partition by t)
"""


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op11_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, reported=BASE)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", *BASE, failed.alias("base_failed"), "kept")


OP11_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
x as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i, len(ws) as n from d),
y as (
  select doc_id, i, i <= n - 7 as whole,
         string_agg(word, ' ') over (partition by doc_id order by i rows between current row and 7 following) as win from x),
z as (select doc_id, i, whole and count(*) over (partition by doc_id, win, whole) > 1 as again from y),
c as (select doc_id, max(again::int) over (partition by doc_id order by i rows between 7 preceding and current row) as covered from z),
r as (select doc_id, sum(covered)::bigint as n_repeat_words from c group by doc_id),
l0 as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
l as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from l0 where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
f as (
  select d.doc_id, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
         length(regexp_replace(t, '[^0-9]', '', 'g')) as n_digits,
         len(list_filter(ws, lambda w: regexp_matches(w, '[A-Za-z\x{C0}-\x{10FFFF}]'))) as n_letter_words,
         coalesce(list_max(list_transform(ws, lambda w: strlen(w))), 0) as longest
  from d left join r using (doc_id) left join l using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or word_chars < 3 * n_words or word_chars > 12 * n_words
            or 2 * n_dup_lines > n_lines or 10 * n_letter_words < 7 * n_words or 10 * n_digits > 3 * word_chars
            or longest > 1000) as kept
from b
"""


def op12_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_spelling(spark, sf_dir):
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), vary=97)


def _crc_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes: two half-byte steps a byte, by a table
    of 16 made from the polynomial."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    step = lambda x: f"xor(({x}) >> 4, {table}[(({x}) & 15) + 1])"
    digit = lambda at: f"(instr('0123456789ABCDEF', substr(h, {at}, 1)) - 1)"
    octets = f"list_transform(range(0, length(h) // 2), lambda i: ({digit('2 * i + 1')} * 16 + {digit('2 * i + 2')})::bigint)"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, b: {step(step('xor(c, b)'))}), 4294967295)"
    return crc.replace("(h)", f"(hex(encode({text})))").replace("substr(h,", f"substr(hex(encode({text})),")


OP13_SQL = rf"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run
  from documents),
own as (select doc_id, run, count(*) as n from runs group by doc_id, run),
hashed as (select *, {_crc_sql("doc_id || ':' || run")} as crc from own),
varied as (
  select case when crc % 97 = 0 then substr(run, 1, (crc % length(run))::int) || substr(run, (crc % length(run))::int + 2) else run end as word, n
  from hashed),
voc as (select word, sum(n)::bigint as n from varied where length(word) >= 5 group by word having sum(n) >= 3),
place as (select word, n, unnest(range(1, length(word) + 1)) as i from voc),
dels as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as part from place),
near as (
  select a.word, b.word as near, b.n from dels a join voc b on b.word = a.part
  union select b.word, a.word as near, a.n from dels a join voc b on b.word = a.part
  union select a.word, b.word as near, b.n from dels a join dels b on a.i = b.i and a.part = b.part and a.word <> b.word),
best as (
  select word, near, n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by n desc, near) as place
  from near),
f as (
  select v.word, case when b.n >= 2 * v.n then b.near end as form, v.n, coalesce(b.n_near, 0)::bigint as n_near,
         case when b.n >= 2 * v.n then b.n end as form_n
  from voc v left join best b on b.word = v.word and b.place = 1),
chain as (
  select word, word as reached, 0 as step from f
  union all select c.word, f.form, c.step + 1 from chain c join f on f.word = c.reached where f.form is not null),
ends as (select word, arg_max(reached, step) as root from chain group by word)
select f.word, form, root, n, n_near, form_n from f join ends using (word)
"""


def queries():
    return {
        "op1_toxicity": op1_toxicity,
        "op2_langid": op2_langid,
        "op3_bpe": op3_bpe,
        "op4_near_dedup": op4_near_dedup,
        "op5_licenses": op5_licenses,
        "op6_decontaminate": op6_decontaminate,
        "op7_line_dedup": op7_line_dedup,
        "op8_pii": op8_pii,
        "op9_token_file": op9_token_file,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_quality": op11_quality,
        "op12_whitening": op12_whitening,
        "op13_spelling": op13_spelling,
    }


def oracle_sql():
    return {
        "op7_line_dedup": OP7_SQL,
        "op10_exact_dedup": OP10_SQL,
        "op11_quality": OP11_SQL,
        "op13_spelling": OP13_SQL,
    }
