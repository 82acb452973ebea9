"""Array-form scoring of stored sequences; large dictionaries; field escapes."""

import random

import pytest
from pyspark.sql import functions as F

from chainwatch.config import DEFAULT_STATES, MarkovConfig
from chainwatch.functions.states import with_index
from chainwatch.functions.text import field, parse_sequence_lines, parse_transaction_lines, sequence_line, transaction_line, unfield
from chainwatch.operators.arrays import score_sequences, sums_before
from chainwatch.operators.model import best_successor, train, transition_counts
from chainwatch.operators.ordering import _blocks, _not_after, running_total, sequence_positions, with_following
from chainwatch.operators.scoring import model_terms, score_windows
from chainwatch.operators.sequences import build_sequences, transitions
from chainwatch.plans.jobs import holdout_split, train_model
from chainwatch.session import work_path
from chainwatch.sources.events import load_tokens
from chainwatch.sources.transactions import decoded_records, read_records, read_sequence_lines, write_sequence_lines

from .conftest import SF001

CFG = MarkovConfig(zero_cell="limit")
ALGORITHMS = ["MissProbability", "MissRate", "EntropyReduction"]


def scores(df, key="customer_id"):
    return {(r[key], r.pos, r.t0, r.t4): r.score for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12) if a[k] is not None and b[k] is not None else a[k] is b[k], k


@pytest.fixture(scope="module")
def chains(spark):
    rng = random.Random(4)
    rows = []
    for c, n in enumerate([1, 4, 5, 6, 7, 8, 11, 12, 14, 21, 23, 60]):
        rows += [(None if c == 9 else f"c{c}", i + 1, rng.choice(DEFAULT_STATES[:6])) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id string, pos bigint, token string")


@pytest.mark.parametrize("algorithm", ALGORITHMS)
@pytest.mark.parametrize("chunk", [5, 7, 1 << 18])
def test_array_scores_equal_window_scores(spark, chains, algorithm, chunk):
    cfg = CFG.with_(chunk=chunk)
    model = train_model(chains, cfg)
    for part in (chains, chains.where("pos > 3")):  # the second starts inside a piece
        want = scores(score_windows(part, model, cfg, "customer_id", algorithm=algorithm))
        same(scores(score_sequences(build_sequences(part, "customer_id", cfg), model, cfg, "customer_id", algorithm=algorithm)), want)


def test_whole_sequences_need_no_exchange_and_no_sort(spark):
    tokens = load_tokens(spark, SF001)
    path = work_path(spark, "test-arrays")
    build_sequences(tokens, "user_id", CFG).write.parquet(path)
    model = train_model(tokens, CFG, key="user_id")
    for algorithm in ALGORITHMS:
        plan = score_sequences(spark.read.parquet(path), model, CFG, "user_id", algorithm=algorithm)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan and "Window" not in plan
        assert plan.count("FileScan") == 1


def test_unknown_and_null_tokens(spark, seq_df):
    seqs = {"a": ["NNL", "NNN", "XXX", "NNL", "NNN", "NNL"], "b": ["NNL", "NNN", "NNL", "NNN", None], "c": ["XXX", "NNL"]}
    tokens = seq_df(seqs)
    model = train_model(seq_df({"m": ["NNL", "NNN", "NNL", "NNL"]}), CFG)
    for chunk in (5, 100):
        cfg = CFG.with_(chunk=chunk, on_unknown="null")
        stored = build_sequences(tokens, "customer_id", cfg)
        for algorithm in ALGORITHMS:
            want = scores(score_windows(tokens, model, cfg, "customer_id", algorithm=algorithm))
            same(scores(score_sequences(stored, model, cfg, "customer_id", algorithm=algorithm)), want)
        with pytest.raises(Exception, match="unknown current state: XXX"):
            score_sequences(stored, model, cfg.with_(on_unknown="error"), "customer_id").collect()
    # too short to have a window, or unknown only as the last token: no failure
    fine = build_sequences(tokens.where("customer_id <> 'a'"), "customer_id", CFG)
    assert score_sequences(fine, model, CFG, "customer_id").count() == 1


def test_sums_before_over_several_blocks(spark):
    for n in (0, 1, 511, 512, 513, 1500):
        (got,) = spark.range(1).select(sums_before(F.transform(F.slice(F.sequence(F.lit(1), F.lit(2000)), 1, n), lambda x: x * 1.0), F.lit(0.0)).alias("s")).first()
        want = [float(i * (i + 1) // 2) for i in range(n)]
        assert got == want


def test_running_totals_without_and_with_several_chunks(spark, chains):
    for chunk in (5, 1000):
        rows = with_following(chains, "customer_id", "pos", [], 1, chunk)
        got = running_total(rows, "customer_id", "pos", {"t": F.col("pos")}).collect()
        assert {(r.customer_id, r.pos): r.t for r in got} == {(r.customer_id, r.pos): r.pos * (r.pos + 1) // 2 for r in got} and len(got) == chains.count()


# -------------------------------------------------------------------------- ordering


def test_splitters_count_what_is_not_after(spark):
    for n in (1, 255, 256, 257, 1000):
        at = F.transform(F.sequence(F.lit(10), F.lit(10 * n), F.lit(10)), lambda x: F.struct(x.alias("a")))
        probes = spark.range(0, 10 * n + 11, 5).withColumn("s", at).withColumn("b", _blocks("s"))
        rows = probes.select("id", _not_after(F.col("b"), F.struct(F.col("id").cast("int").alias("a"))).alias("k")).collect()
        assert all(r.k == min(n, r.id // 10) for r in rows)


def test_hot_path_stores_splitters_only(spark, monkeypatch):
    from chainwatch.operators import ordering

    stored = []
    real = ordering.checkpointed
    monkeypatch.setattr(ordering, "checkpointed", lambda df: stored.append(real(df)) or stored[-1])
    rows = load_tokens(spark, SF001).select(F.when(F.col("user_id") > 4, F.col("user_id")).alias("user_id"), "ts", "event_id", "token")
    hot = sequence_positions(rows, "user_id", ["ts", "event_id"], carry=["token"], hot_rows=40)
    key = lambda df: sorted((r.event_id, r.pos, r.prev_token) for r in df.collect())
    assert key(hot) == key(sequence_positions(rows, "user_id", ["ts", "event_id"], carry=["token"]))
    slices = rows.count() // 40
    assert sum(df.count() for df in stored) <= slices
    assert "Exchange rangepartitioning" not in hot._jdf.queryExecution().executedPlan().toString()


def test_cold_cells_need_one_small_aggregate(spark, monkeypatch):
    from chainwatch.operators import ordering

    monkeypatch.setattr(ordering, "checkpointed", lambda df: pytest.fail("no key is hot"))
    assert sequence_positions(load_tokens(spark, SF001).drop("pos"), "user_id", ["ts", "event_id"]).count() == 1000


# -------------------------------------------------------------------------- large dictionaries

LARGE = tuple(f"s{i}" for i in range(5000))


def brute(seqs, cfg, algorithm):
    """Scores from the definitions, with a dictionary of cells."""
    n, rows = {}, {}
    for s in seqs.values():
        for a, b in zip(s, s[1:]):
            n[a, b] = n.get((a, b), 0) + 1
            rows[a] = rows.get(a, 0) + 1
    at = {s: i for i, s in enumerate(cfg.states)}
    best = {a: min((x for x in n if x[0] == a), key=lambda x: (-n[x], at[x[1]]))[1] for a in rows}
    import math

    h = {x: -(n[x] / rows[x[0]]) * math.log(n[x] / rows[x[0]]) for x in n}
    whole = {a: sum(h[x] for x in h if x[0] == a) for a in rows}
    out = {}
    for c, s in seqs.items():
        steps = list(zip(s, s[1:]))
        for p in range(len(s) - 4):
            part = steps[p : p + 4]
            if algorithm == "MissProbability":
                score = sum((rows[a] - n.get((a, b), 0)) / rows[a] if a in rows else 0.0 for a, b in part) / 4
            elif algorithm == "MissRate":
                score = sum(b != best.get(a, cfg.states[0]) for a, b in part) / 4
            else:
                seen = steps[: p + 4]
                den = sum(whole.get(a, 0.0) for a, _ in seen)
                score = (sum(whole.get(a, 0.0) - h.get((a, b), 0.0) for a, b in seen) / den / 4) if den else None
            out[c, p + 1, s[p], s[p + 4]] = score
    return out


def test_five_thousand_states(spark, seq_df):
    rng = random.Random(8)
    seqs = {f"c{k}": [rng.choice(LARGE) if rng.random() < 0.5 else f"s{rng.randrange(12)}" for _ in range(rng.randrange(3, 40))] for k in range(25)}
    cfg = MarkovConfig(states=LARGE, zero_cell="limit", chunk=13)
    assert not cfg.dense
    tokens = seq_df(seqs)
    model = train_model(tokens, cfg)
    for algorithm in ALGORITHMS:
        got = score_windows(tokens, model, cfg, "customer_id", algorithm=algorithm)
        same(scores(got), brute(seqs, cfg, algorithm))
        same(scores(score_sequences(build_sequences(tokens, "customer_id", cfg), model, cfg, "customer_id", algorithm=algorithm)), brute(seqs, cfg, algorithm))
    odd = seq_df({"x": ["s1", "s2", "nowhere", "s1", "s2"], "y": ["s1", "s2", "s1", "s2", "nowhere"]})
    with pytest.raises(Exception, match="unknown current state: nowhere"):
        score_windows(odd, model, cfg, "customer_id").collect()
    lenient = scores(score_windows(odd, model, cfg.with_(on_unknown="null"), "customer_id"))
    assert lenient["x", 1, "s1", "s2"] is None and lenient["y", 1, "s1", "nowhere"] is not None
    with pytest.raises(Exception, match="unknown"):
        transition_counts(transitions(odd, "customer_id", cfg), cfg).collect()


@pytest.mark.parametrize("algorithm", ALGORITHMS)
@pytest.mark.parametrize("zero_cell", ["limit", "undefined"])
def test_sparse_lookups_equal_dense_ones(spark, chains, algorithm, zero_cell, monkeypatch):
    cfg = CFG.with_(zero_cell=zero_cell)
    model = train_model(chains.where("customer_id <> 'c3'"), cfg)
    want = scores(score_windows(chains, model, cfg, "customer_id", algorithm=algorithm))
    monkeypatch.setattr(MarkovConfig, "dense", property(lambda self: False))
    same(scores(score_windows(chains, model, cfg, "customer_id", algorithm=algorithm)), want)


def test_joined_indices(spark):
    df = spark.createDataFrame([("s4999", "s0"), (None, "nowhere")], "a string, b string")
    assert [(r.i, r.j) for r in with_index(df, {"a": "i", "b": "j"}, LARGE).collect()] == [(4999, 0), (-1, -1)]


# -------------------------------------------------------------------------- lines and records


def test_fields_survive_lines(spark, seq_df):
    odd = ["\\N", "\\", "@7", "@x", "", None, "é", "\\\\N", "plain"]
    df = spark.createDataFrame([(c, "1", t) for c in odd for t in odd], "c string, x string, t string")
    back = parse_transaction_lines(df.select(transaction_line("c", "x", "t").alias("value")))
    assert [(r.customer_id, r.token) for r in back.collect()] == [(c, t) for c in odd for t in odd]
    line = df.select(sequence_line(F.col("c"), F.array("t", "t", F.lit("")), F.lit(None).cast("int")).alias("value"), sequence_line(F.col("c"), F.array("t")).alias("v2"))
    back = parse_sequence_lines(line.select(F.col("v2").alias("value"))).collect()
    assert [(r.customer_id, r.first_pos, r.tokens) for r in back] == [(c, None, [t]) for c in odd for t in odd]
    assert spark.range(1).select(unfield(field(F.lit(None).cast("string")))).first()[0] is None


def test_null_and_empty_customers_stay_apart(spark, seq_df):
    tokens = seq_df({None: ["LNL", None, "LNN", "LNS"], "": ["HHH", "LNL"]})
    path = work_path(spark, "test-null-lines")
    for chunk in (2, 100):
        cfg = MarkovConfig(window=2, chunk=chunk)
        write_sequence_lines(build_sequences(tokens, "customer_id", cfg), path)
        long = read_sequence_lines(spark, path)
        got = sorted((r.customer_id or str(r.customer_id), r.pos, r.src, r.dst) for r in transitions(long, ["customer_id", "line_id"], cfg).collect())
        assert got == sorted([("None", 1, "LNL", "NULL"), ("None", 2, "NULL", "LNN"), ("None", 3, "LNN", "LNS"), ("", 1, "HHH", "LNL")], key=lambda r: (r[0] or str(r[0]), *r[1:]))


def test_split_of_null_values(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, 3), ("a", 3, 9)], "customer_id string, pos int, at int")
    before, after = holdout_split(rows, "at", 5)
    assert ([r.pos for r in before.collect()], [r.pos for r in after.collect()]) == ([1, 2], [3])


def test_byte_records(spark):
    path = work_path(spark, "test-records")
    rows = [(b"a", "a,1,NNL".encode(), 0, 5), (b"b", "é,2,NNN".encode(), 1, 0), (None, b"\xff\xfe,1,X", 0, 6), (None, None, 2, 0)]
    spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint").write.parquet(path)
    with pytest.raises(Exception, match="malformed"):
        read_records(spark, path).collect()
    good = read_records(spark, path, mode="permissive")
    assert sorted(tuple(r) for r in good.collect()) == [("a", "1", "NNL", 0, 5), ("é", "2", "NNN", 1, 0)]
    bad = [r.value for r in decoded_records(spark.read.parquet(path)).where("kafka_partition = 0 and kafka_offset = 6").collect()]
    import base64

    assert base64.b64decode(bad[0][1:]) == b"\xff\xfe,1,X"


def test_terms_stand_for_the_model(spark, chains):
    model = train_model(chains, CFG)
    terms = model_terms(model, CFG)
    same(scores(score_windows(chains, None, CFG, "customer_id", terms=terms)), scores(score_windows(chains, model, CFG, "customer_id")))
    assert best_successor(model, CFG).count() == 18 and train(transitions(chains, "customer_id", CFG), CFG).count() == model.count()
