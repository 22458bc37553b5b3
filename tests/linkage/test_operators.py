import math
import os
import random
from collections import defaultdict
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import fuzzy
from tessera.operators import blocking, decide, dense, dictionaries, features, index, metrics, models, sampling, validate
from tessera.plans import linkage, queries, roles
from tessera.sources import tables

CAP = 5


def records(spark, rows):
    return spark.createDataFrame(rows, "country string, source int, id long, keys array<string>")


def scores_by_hand(queries, pool, cap):
    df = defaultdict(int)
    for *_, keys in pool:
        for k in set(keys):
            df[k] += 1
    idf = {k: math.log(len(pool) / (1 + c)) for k, c in df.items() if c <= cap}

    def vector(keys):
        v = {k: idf[k] for k in set(keys) if k in idf}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {k: x / norm for k, x in v.items()}

    out = {}
    for _, _, s1, q in queries:
        a = vector(q)
        for _, source, i, p in pool:
            b = vector(p)
            if a.keys() & b.keys():
                out[s1, source, i] = sum(a[k] * b[k] for k in a.keys() & b.keys())
    return out


@pytest.mark.parametrize("seed", range(3))
def test_channel_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    make = lambda source, n: [("x", source, i, [f"k{rng.randint(0, 30)}" for _ in range(rng.randint(0, 8))]) for i in range(n)]
    queries, pool = make(1, 30), make(2, 60) + make(3, 20)
    pool += [("x", 2, 100 + i, ["common", f"rare{i}"]) for i in range(10)]
    vocab = index.vocabulary(records(spark, pool), F.col("keys"), ("source", "id"), CAP)
    kept = {r.key for r in vocab.collect()}
    assert "common" not in kept and {f"rare{i}" for i in range(10)} <= kept
    expected = scores_by_hand(queries, pool, CAP)
    got = {(r.s1, r.source, r.id): r.score for r in index.channel_scores(records(spark, queries), records(spark, pool), F.col("keys"), CAP).collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())
    top = index.channel_top_k(records(spark, queries), records(spark, pool), F.col("keys"), CAP, 3).collect()
    for s1 in {r.s1 for r in top}:
        best = sorted((-round(v, 9), k[1], k[2]) for k, v in expected.items() if k[0] == s1)[:3]
        assert [(r.source, r.id) for r in sorted((r for r in top if r.s1 == s1), key=lambda r: r.rank)] == [b[1:] for b in best]


def test_fusion_and_competition(spark):
    ranked = lambda rows: spark.createDataFrame([("x", *r) for r in rows], "country string, s1 long, source int, id long, rank int")
    fused = blocking.fuse([ranked([(1, 2, 7, 1), (2, 2, 7, 2)]), ranked([(1, 2, 7, 3), (1, 3, 8, 1)])])
    got = {(r.s1, r.source, r.id): r.rrf for r in fused.collect()}
    assert got == {(1, 2, 7): pytest.approx(1 / 61 + 1 / 63), (2, 2, 7): pytest.approx(1 / 62), (1, 3, 8): pytest.approx(1 / 61)}
    # A matrix [[3, 5], [1, 0], [2, 0]]: rows are S1, columns are records.
    scores = spark.createDataFrame([("x", 1, 2, 1, 3.0), ("x", 1, 2, 2, 5.0), ("x", 2, 2, 1, 1.0), ("x", 3, 2, 1, 2.0)], "country string, s1 long, source int, id long, rrf double")
    stats = lambda df: {r.id: (r.best, r.second, r.rivals) for r in df.collect()}
    assert stats(blocking.competition(scores)) == {1: (3, 2, 3), 2: (5, 0, 1)}
    parts = [blocking.competition(scores.where(f"s1 = {i}")) for i in (1, 2, 3)]
    assert stats(blocking.merge_competition(parts)) == stats(blocking.competition(scores))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_competition_of_large_parts(spark, tmp_path, adaptive):
    """Parts that are too large to be broadcast, with exchanges that are used again."""
    fused = spark.range(3000).select(F.lit("x").alias("country"), F.col("id").alias("s1"), (F.pmod(F.hash("id"), F.lit(2)) + 2).alias("source"), F.pmod(F.hash("id", F.lit(1)), F.lit(200)).cast("long").alias("id"), (F.pmod(F.hash("id", F.lit(2)), F.lit(50)) / 50).alias("rrf"))
    tables.save(fused, str(tmp_path))
    fused = tables.load(spark, str(tmp_path))
    scores = defaultdict(list)
    for r in fused.collect():
        scores[r.source, r.id].append(r.rrf)
    want = {k: (*sorted([*v, 0.0], reverse=True)[:2], len(v)) for k, v in scores.items()}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        parts = [blocking.competition(fused.where(F.col("s1") % 3 == k)) for k in range(3)]
        merged = blocking.merge_competition(parts)
        first = parts[0].select("country", "source", "id", F.col("best").alias("first"))
        again = merged.join(first, ["country", "source", "id"], "left").collect()
        for rows in (merged.collect(), again):
            assert len(rows) == len(want) and {(r.source, r.id): (r.best, r.second, r.rivals) for r in rows} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_blocking_quality(spark):
    s1 = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "country string, id long")
    pool = spark.createDataFrame([("x", 2, 1), ("x", 3, 2), ("y", 2, 3)], "country string, source int, id long")
    truth = spark.createDataFrame([(1, 2, 1), (2, 3, 2), (2, 3, 2), (1, 2, 99)], "s1 long, source int, id long")
    cand = spark.createDataFrame([("x", 1, 2, 1, 2), ("x", 1, 3, 2, 1)], "country string, s1 long, source int, id long, rank int")
    got = {r.country: r for r in blocking.quality(cand, truth, s1, pool).collect()}
    assert (got["x"].pc, got["x"].rr, got["x"].pq) == (0.5, 0.5, 0.5) and (got["y"].pc, got["y"].pq) == (1.0, 0.0)
    known = blocking.known_truth(truth, s1, pool)
    recall = blocking.recall_at(cand, known, (1, 2))
    assert {r.k: r.recall for r in recall.collect()} == {1: 0.0, 2: 0.5} and blocking.choose_k(recall).first().k == 2
    assert blocking.admit_dense(0.8, 0.81) and not blocking.admit_dense(0.8, 0.801)


@pytest.mark.parametrize("block, side", [(16, 8), (4, 2)])
def test_knn_equals_numpy(spark, block, side):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(120, 8))
    rows = spark.createDataFrame([("xy"[i % 2], 2, i, v[i].tolist()) for i in range(120)], "country string, source int, id long, embedding array<float>")
    got = dense.exact_knn(rows.select("country", F.col("id").alias("s1"), "embedding"), rows, 5, block=block, side=side, same_id=False).collect()
    assert len(got) == 120 * 5
    for s1 in range(0, 120, 7):
        mates = [j for j in range(s1 % 2, 120, 2) if j != s1]
        best = sorted(mates, key=lambda j: -float(v[s1] @ v[j]))[:5]
        assert [r.id for r in sorted((r for r in got if r.s1 == s1), key=lambda r: r.rank)] == best
    texts = spark.createDataFrame([("acme bank",), ("acme banks",), ("zzz",)], ["t"])
    e = [np.array(r.embedding) for r in dense.encode_texts(texts, "t").collect()]
    assert e[0] @ e[1] > 0.6 > abs(e[0] @ e[2])


def pairs(spark, rows):
    return spark.createDataFrame(rows, "country string, s1 long, source int, id long, prob double")


def prefix_by_loop(p):
    none, best, m = math.prod(1 - x for x in p), None, 0
    best = none
    for n in range(1, len(p) + 1):
        head, total = sum(p[:n]), sum(p)
        if total <= 0:
            break
        precision, recall = head / n, head / total
        f = 1.25 * precision * recall / (0.25 * precision + recall) if head else 0.0
        if round(f, 12) > round(best, 12):
            best, m = f, n
    return m


def test_decisions_equal_loops(spark):
    rng = random.Random(0)
    rows = [("xy"[s % 2], s, 2 + r % 2, r, round(rng.random() ** 3, 6)) for s in range(120) for r in rng.sample(range(160), rng.randint(0, 7))]
    owner = {}
    for row in sorted(rows, key=lambda r: (-r[4], r[1])):
        owner.setdefault(row[2:4], row)
    got = decide.one_owner(pairs(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(owner.values())
    by_s1 = defaultdict(list)
    for row in owner.values():
        by_s1[row[1]].append(row)
    for tau in (0.05, 0.3, 0.6):
        expected = set()
        for s, own in by_s1.items():
            own.sort(key=lambda r: (-r[4], r[2], r[3]))
            m = prefix_by_loop([r[4] for r in own])
            while m and own[m - 1][4] < tau:
                m -= 1
            expected |= {r[1:4] for r in own[:m]}
        assert {tuple(r) for r in decide.decide(got, tau).collect()} == expected
    truth = spark.createDataFrame([r[1:4] for r in rows if r[4] > 0.4], "s1 long, source int, id long")
    ids = spark.createDataFrame([(s, "xy"[s % 2]) for s in range(120)], "s1 long, country string")
    sweep = {r.tau: r.score for r in decide.sweep_tau(got, truth, ids).collect()}
    best = decide.best_tau(decide.sweep_tau(got, truth, ids)).first()
    assert len(sweep) == 19 and best.score == pytest.approx(max(sweep.values()))
    assert metrics.macro_f05(decide.decide(got, best.tau), truth, ids).first().score == pytest.approx(best.score)
    tier = decide.finish_tier(pairs(spark, rows), pairs(spark, rows), pairs(spark, rows), truth, ids, ids, ids)
    assert tier["tau"] == best.tau and tier["vcal_f05"] == pytest.approx(best.score) and set(tier["vtest_f05_by_country"]) == {"x", "y"}
    assert tier["predictions"].count() == 120


def test_metrics(spark):
    p = spark.createDataFrame([(1, 2, 47), (1, 2, 193), (1, 3, 812), (3, 2, 1)], "s1 long, source int, id long")
    t = spark.createDataFrame([(1, 2, 47), (1, 3, 812), (4, 2, 5)], "s1 long, source int, id long")
    ids = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "y")], "s1 long, country string")
    f = {r.s1: r.f05 for r in metrics.entity_f05(p, t, ids).collect()}
    assert f[1] == pytest.approx(0.714, abs=1e-3) and (f[2], f[3], f[4]) == (1, 0, 0)
    by = {r.country: r.score for r in metrics.macro_f05(p, t, ids, by="country").collect()}
    assert by["y"] == 0 and by[None] == pytest.approx((f[1] + 1) / 4)
    assert {r.s1: len(r.truth) for r in metrics.truth_sets(t, ids).collect()} == {1: 2, 2: 0, 3: 0, 4: 1}
    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "prob double, label int")
    assert metrics.average_precision(scored).first().ap == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_context_and_graph_features(spark):
    df = pairs(spark, [("x", 1, 2, 1, 0.9), ("x", 1, 2, 2, 0.6), ("x", 1, 3, 3, 0.2), ("x", 2, 2, 1, 0.5)]).withColumn("new_prob", F.when(F.col("id") == 2, 0.95))
    got = {(r.s1, r.id): r for r in decide.context_features(df).collect()}
    assert (got[1, 2].comb_rank, got[1, 1].comb_rank, got[1, 1].comb_n_half) == (1, 2, 2) and got[1, 3].comb_gap == pytest.approx(0.75) and got[1, 1].scored == 0
    cand = spark.createDataFrame([("x", 1, 2, 1, 0.03, 1), ("x", 1, 3, 2, 0.01, 2), ("x", 2, 2, 1, 0.02, 1), ("x", 3, 2, 1, 0.01, 1)], "country string, s1 long, source int, id long, rrf double, rank int")
    rev = {(r.s1, r.id): r for r in features.graph_features(cand, blocking.competition(cand)).collect()}
    assert [rev[s, 1].reverse_rank for s in (1, 2, 3)] == [1, 2, 3] and rev[1, 2].gap_to_s1_best == pytest.approx(0.02) and rev[1, 2].is_s3 == 1 and rev[3, 1].gap_to_record_best == pytest.approx(0.02)


def test_dictionaries(spark):
    names = spark.createDataFrame([("x", "acme intl co"), ("x", "best intl co"), ("x", "international co"), ("y", "solo")], "country string, name string")
    vocab = {r.country: set(r.forms) for r in dictionaries.legal_form_vocabulary(names, seeds=("inc",), min_count=2, top_n=1).collect()}
    assert vocab == {"x": {"inc", "co"}, "y": {"inc"}}
    short = dictionaries.frequent_short_tokens(names, max_len=4, top_n=5, min_count=2)
    assert {(r.country, r.token) for r in short.collect()} == {("x", "co"), ("x", "intl")}
    tried = spark.createDataFrame([("x", "intl", "International"), ("x", "co", "company")], "country string, token string, expansion string")
    assert [tuple(r) for r in dictionaries.abbreviation_map(short, tried, dictionaries.token_vocabulary(names, longer_than=4)).collect()] == [("x", "intl", "international")]
    aligned = spark.createDataFrame([(["राम", "x"], ["Ram", "y"]), (["राम"], ["ram", "z"]), (["राम"], ["rama"]), (["सीता"], ["sita"])], "src_tokens array<string>, dst_tokens array<string>")
    learned = dictionaries.aligned_dictionary(aligned)
    assert [tuple(r) for r in learned.collect()] == [("राम", "ram", 2)]
    missing = dictionaries.missing_tokens(spark.createDataFrame([("राम सीता",)], ["name"]), "name", learned)
    assert [r.token for r in missing.collect()] == ["सीता"]
    more = dictionaries.extend_dictionary(learned, missing, lambda c: F.lit("Sita"))
    assert {tuple(r) for r in more.collect()} == {("राम", "ram"), ("सीता", "sita")}


def test_sampling(spark):
    s1 = spark.createDataFrame([(i, "x" if i % 4 else "y") for i in range(200)], "id long, country string")
    split = sampling.stratified_split(s1, {"T": 100, "Vcal": 20, "Vtest": 20})
    counts = {(r.country, r.split): r["count"] for r in split.groupBy("country", "split").count().collect()}
    assert counts["x", "T"] == 75 and counts["y", "Vcal"] == 5 and counts["x", "Vtest"] == 15 and sum(counts.values()) == 200
    with pytest.raises(ValueError):
        sampling.stratified_split(s1, {"T": 201})
    assert {r.country: r["count"] for r in sampling.stratified_sample(s1, 2).groupBy("country").count().collect()} == {"x": 2, "y": 1}
    pool = spark.createDataFrame([(2 + i % 2, i) for i in range(40)], "source int, id long")
    truth = spark.createDataFrame([(1, 2, 0), (1, 2, 2)], "s1 long, source int, id long")
    assert sampling.distractors(pool, truth, 5).count() == 12
    ranked = spark.createDataFrame([(1, 2, i, i + 1) for i in range(20)], "s1 long, source int, id long, rank int")
    made = sampling.training_pairs(ranked, truth, 4).collect()
    assert sorted(r.label for r in made) == [0, 0, 1, 1]
    probs = pairs(spark, [("x", 1, 2, i, i / 10) for i in range(11)])
    assert {r.id for r in sampling.closest_to_half(probs, 3).collect()} == {4, 5, 6}
    ranked = decide.rank_in_s1(probs)
    assert {r.id for r in sampling.uncertain_band(ranked, 3).collect()} == {8, 9} and {r.id for r in sampling.judge_band(ranked).collect()} == set(range(2, 9))


def test_validation(spark):
    lists = spark.createDataFrame([("S1-1", "S2-1,S3-1"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], ["entity_id"])
    known = spark.createDataFrame([("S2-1",), ("S3-1",)], ["entity_id"])
    assert validate.violations(lists, required, known).isEmpty()
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-2"), ("S1-9", "X-1,S3-7"), ("junk", None), ("", None)], lists.schema)
    got = {r.rule: r.examples for r in validate.summary(validate.violations(bad, required, known)).collect()}
    assert got == {"repeated_id": ["S1-1"], "duplicate_row": ["S1-1"], "self_match": ["S1-2"], "wrong_prefix": ["X-1"], "unknown_id": ["S3-7"], "malformed_row": ["junk"], "missing_s1": ["S1-2"], "extra_s1": ["S1-9"]}
    assert set(got) == set(validate.ERRORS)
    matched = validate.list_pairs(lists, "source1_entity_id", "matched_entity_ids")
    assert validate.not_candidates(matched, matched.where("id = 'S2-1'")).first().example == "S1-1:S3-1"
    assert validate.header_problem(["a,b"], validate.MATCH_HEADER) and validate.header_problem(list(validate.MATCH_HEADER), validate.MATCH_HEADER) is None


def test_models(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        label = int(rng.random() < 0.4)
        rows.append(("xy"[i % 2], i // 4, 2, i, label + rng.gauss(0, 0.3), rng.random(), label, "T" if i % 3 else "Vcal"))
    table = spark.createDataFrame(rows, "country string, s1 long, source int, id long, f double, g double, label int, split string")
    assert models.feature_columns(table) == ["f", "g"]
    model = models.train_trees(table.where("split = 'T'"), depth=3, rounds=5, step=0.3)
    scored = models.score_trees(model, table)
    assert metrics.average_precision(scored.where("split = 'Vcal'"), "raw_score").first().ap > 0.9
    platt = models.apply_platt(models.fit_platt(scored, ["raw_score"]), scored)
    assert platt.where("prob between 0 and 1").count() == 400 and platt.where("label = 1").agg(F.avg("prob")).first()[0] > 0.7
    ap = models.leave_one_country_out(table, depth=2, rounds=3, step=0.3)
    assert set(ap) == {"x", "y"} and min(ap.values()) > 0.9
    again = models.align_scores(platt, platt.where("id < 100").select("s1", "source", "id", F.lit(2.0).alias("new_prob")), logits=True)
    assert again.where("new_prob is not null").count() == 100
    stacked = models.apply_stacker(models.fit_stacker(again, rounds=3, depth=3), again)
    assert stacked.where("stacked between 0 and 1").count() == 400


def test_gate():
    base = {"vcal_f05": 0.9, "vcal_f05_by_country": {"x": 0.9, "y": 0.9}}
    ok = {"vcal_f05": 0.902, "vcal_f05_by_country": {"x": 0.906, "y": 0.8985}}
    worse = {"vcal_f05": 0.93, "vcal_f05_by_country": {"x": 0.96, "y": 0.89}}
    assert linkage.passes_gate(base, ok) and not linkage.passes_gate(base, worse) and not linkage.passes_gate(base, base)
    assert linkage.passes_gate(base, {"vcal_f05": 0.95, "vcal_f05_by_country": {"x": 0.95}})
    assert linkage.choose_tier({"v1": base, "v2": ok, "v3": worse}) == "v2"


def test_files(spark, tmp_path):
    tsv = tmp_path / "s.tsv"
    tsv.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-7\tNA\t\tx\nS2-8\tA, b\tc\tx\n")
    rows = tables.load_source(spark, str(tsv)).collect()
    assert [(r.source, r.id, r.name, r.address) for r in rows] == [(2, 7, "NA", ""), (2, 8, "A, b", "c")]
    gt = tmp_path / "t.tsv"
    gt.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-7,S3-9\nS1-2\t\n")
    truth = tables.load_truth(spark, str(gt))
    assert {tuple(r) for r in truth.collect()} == {(1, 2, 7), (1, 3, 9)}
    ids = spark.createDataFrame([(1,), (2,)], ["s1"])
    out = str(tmp_path / "lists")
    tables.write_tsv(tables.format_lists(decide.with_all(truth, ids)), out)
    lines = sorted(x for f in (tmp_path / "lists").glob("*.csv") for x in f.read_text().splitlines() if not x.startswith("source1"))
    assert lines == ["S1-1\tS2-7,S3-9", "S1-2\t"]
    read = {r.source1_entity_id: r.matched_entity_ids for r in tables.read_lists(spark, out, ("source1_entity_id", "matched_entity_ids")).collect()}
    assert read == {"S1-1": "S2-7,S3-9", "S1-2": ""}
    targets, warned = tables.match_targets(spark, [str(tsv), str(tmp_path / "none.tsv")])
    assert targets is None and len(warned) == 1 and tables.match_targets(spark, [str(tsv)])[0].count() == 2
    stage = str(tmp_path / "stage")
    tables.save(tables.load_source(spark, str(tsv)), stage, by="country")
    assert tables.load(spark, stage, ["id"], "x").count() == 2
    assert not tables.is_done(spark, stage, {"k": 1})
    tables.mark_done(spark, stage, {"k": 1})
    assert tables.is_done(spark, stage, {"k": 1}) and not tables.is_done(spark, stage, {"k": 2})
    tables.promote(spark, out, str(tmp_path / "final"))
    assert tables.read_lists(spark, str(tmp_path / "final"), ("source1_entity_id", "matched_entity_ids")).count() == 2


def test_stream(spark, tmp_path):
    from tessera.streaming.ingest import normalize_stream

    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in (1, 2):
        (inbox / f"{n}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-{n}\tAcme No {n}\tMain\tx\n")
        query = normalize_stream(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    got = sorted((r.id, r.name_clean) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, "acme no 1"), (2, "acme no 2")]


def test_whole_plan(spark):
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeo" for c in "mnrst"]
    rows, truth = [], []
    for i in range(90):
        name = [rng.choice(words) for _ in range(3)]
        country, split = "xy"[i % 2], ("T", "Vcal", "Vtest", "test")[i % 4]
        rows.append((1, i, country, " ".join(name), "12 main", split))
        rows.append((2, i, country, " ".join([*name[:2], rng.choice(words)]), "12 main", ""))
        rows.append((3, i, country, " ".join(rng.choice(words) for _ in range(3)), "9 side", ""))
        truth.append((i, 2, i))
    from tessera.plans.normalize import normalize_records

    table = normalize_records(spark.createDataFrame(rows, "source int, id long, country string, name string, address string, split string")).cache()
    s1, pool = table.where("source = 1"), table.where("source > 1").drop("split")
    tier = linkage.link(s1, pool, spark.createDataFrame(truth, "s1 long, source int, id long"), k=5, trees={"depth": 2, "rounds": 4, "step": 0.5}, word_cap=200, ngram_cap=200)
    assert tier["vcal_f05"] > 0.7 and tier["predictions"].count() == s1.where("split = 'test'").count()


def test_exact_channel(spark):
    """A group of equal records gives each S1 record k candidates, the first by source and id."""
    rows = [("x", 1, i, "n", "a") for i in range(40)] + [("x", 2 + i % 2, i, "n", "a") for i in range(90)] + [("y", 2, 500, "n", "a"), ("x", 2, 501, "n", "b"), (None, 2, 502, "n", "a")]
    df = spark.createDataFrame(rows, "country string, source int, id long, name_clean string, address_clean string")
    out = linkage.exact_channel(df.where("source = 1"), df.where("source > 1"), 5).collect()
    assert len(out) == 200 and {(r.source, r.id, r.rank) for r in out} == {(2, 2 * k, k + 1) for k in range(5)}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_blocking(spark, sf):
    """Truth is all pairs of equal records. At 50 candidates none is lost; at 10, none that ten places can hold."""
    folder = f"/root/testdata/{sf}"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    recall = {r.k: r.recall for r in queries.queries()["recall_at_k"](spark, folder).collect()}
    n = queries.roles.truth(*queries.roles.sides(spark, folder)).groupBy("s1").count()
    most = n.selectExpr("sum(least(count, 10)) / sum(count)").first()[0]
    assert recall[50] >= 0.99 and recall[10] >= 0.95 * most


def test_records_are_staged_once_for_a_version_of_the_documents(spark, tmp_path):
    from tessera.plans import roles

    def put(ids, day):
        path = tmp_path / "documents.parquet"
        pd.DataFrame({"doc_id": ids, "text": ["acme ltd\n1 low street"] * len(ids), "lang": "en", "source": "src1", "n_chars": 10}).to_parquet(path)
        os.utime(path, (day * 86400, day * 86400))

    put([1, 2], 100)
    first = roles.records(spark, str(tmp_path))
    assert first.count() == 2 and roles.records(spark, str(tmp_path)) is first
    put([1, 2, 3], 101)
    assert sorted(r.id for r in roles.records(spark, str(tmp_path)).collect()) == [1, 2, 3]


@pytest.mark.parametrize("held, chunk, sent", [(7, 20, 1000), (1000, 10**6, 1000), (7, 20, 3)])
def test_channel_in_parts_equals_brute_force(spark, held, chunk, sent):
    """Parts of S1, chunks of the pool and the join of large vocabularies find the same, equal scores by source and id."""
    rng = random.Random(held)
    make = lambda source, n: [("x", source, i, [f"k{rng.randint(0, 12)}" for _ in range(rng.randint(0, 4))]) for i in range(n)]
    queries, pool = make(1, 40), make(3, 50) + make(2, 50)
    nowhere = [(None, 2, 900, ["k1"]), ("z", 2, 901, ["k1"]), ("z", 2, 902, [])]
    expected = scores_by_hand(queries, pool, 30)
    got = index.channel_top_k(records(spark, queries + [("w", 1, 99, ["k1"])]), records(spark, pool + nowhere), F.col("keys"), 30, 4, sent, held, chunk)
    assert dict(got.dtypes) == {"country": "string", "s1": "bigint", "source": "int", "id": "bigint", "score": "double", "rank": "int"}
    rows = got.collect()
    assert {r.s1 for r in rows} == {k[0] for k in expected}
    for s1 in {k[0] for k in expected}:
        best = sorted((-round(v, 9), *k[1:]) for k, v in expected.items() if k[0] == s1)[:4]
        assert [(r.source, r.id) for r in sorted((r for r in rows if r.s1 == s1), key=lambda r: r["rank"])] == [b[1:] for b in best]


def test_channel_does_not_shuffle_pairs(spark):
    """Pairs that share a key are many times the records: they are summed in the task where they arise, not joined and grouped."""
    rows = records(spark, [("x", 1 + i % 2, i, ["a", f"k{i % 5}"]) for i in range(40)])
    got = index.channel_top_k(rows.where("source = 1"), rows.where("source = 2"), F.col("keys"), 100, 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and got.count() == 60


def test_channel_of_nothing(spark):
    """Without a key of the pool there are no pairs; a key in all records but one weighs nothing and still makes pairs."""
    empty, one = records(spark, []), records(spark, [("x", 2, 1, ["a"]), ("x", 2, 2, [])])
    assert index.channel_top_k(one, empty, F.col("keys"), 5).isEmpty() and index.channel_top_k(empty, one, F.col("keys"), 5).isEmpty()
    got = index.channel_top_k(one, one, F.col("keys"), 5).collect()
    assert [(r.s1, r.id, r.score) for r in got] == [(1, 1, 0.0)]


@pytest.mark.parametrize("held, most", [(2, 1000), (1000, 1000), (1000, 1)])
def test_idf_cosines_equal_brute_force(spark, held, most):
    """In parts of S1, in one, and by the joins of a large vocabulary."""
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, n)))
    rows = [("xy"[i % 2], 1 + i % 3, i, text(3), text(6)) for i in range(60)] + [("x", 1, 100, "unknown", ""), (None, 2, 101, "a", "b")]
    table = spark.createDataFrame(rows, "country string, source int, id long, name_clean string, address_clean string")
    table = table.withColumns({**{c: F.lit("") for c in ("legal_form", "name_nospace", "postcode")}, "addr_numbers": F.array().cast("array<string>"), "name_transliterated": F.lit(False)})
    s1, pool = [r for r in rows if r[1] == 1], [r for r in rows if r[1] > 1]
    pairs_ = [(a[0], a[2], b[1], b[2]) for a in s1 for b in pool if a[0] == b[0] and (a[2] + b[2]) % 3]
    got = features.idf_cosines(spark.createDataFrame(pairs_, "country string, s1 long, source int, id long"), table.where("source = 1"), table.where("source > 1"), most, held)
    record, idf = {r[2]: r for r in rows}, {}
    for c in "xy":
        mine = [r for r in pool if r[0] == c]
        for w in "abcdefgh":
            if df := sum(w in (r[3] + " " + r[4]).split() for r in mine):
                idf[c, w] = math.log(len(mine) / (1 + df))
    weigh = lambda c, ws: sum(idf.get((c, w), 0.0) ** 2 for w in ws)
    expected = {}
    for c, a, source, b in pairs_:
        x, y = [[set(record[i][f].split()) for f in (3, 4)] for i in (a, b)]
        expected[c, a, source, b] = [weigh(c, u & v) / math.sqrt(weigh(c, u) * weigh(c, v)) if weigh(c, u) and weigh(c, v) else 0.0 for u, v in zip(x, y)]
    found = {tuple(r)[:4]: tuple(r)[4:] for r in got.collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())


def test_fusion_deals_pairs_once(spark):
    """The sums and the ranks of fused pairs need no exchange but the one by S1 record."""
    ranked = spark.createDataFrame([("x", 1, 2, 7, 1), ("x", 1, 3, 8, 2)], "country string, s1 long, source int, id long, rank int")
    plan = blocking.prune(blocking.fuse([ranked, ranked]), 5)._jdf.queryExecution().sparkPlan().toString()
    planned = blocking.prune(blocking.fuse([ranked, ranked]), 5)._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange") == 1 and "Window" in plan


def test_truth_shuffles_no_text(spark):
    """Equal records meet by a digest of their texts; where name ends and address begins counts."""
    from tessera.plans import roles

    rows = spark.createDataFrame([("x", 1, 1, "a", "bc"), ("x", 2, 2, "a", "bc"), ("x", 2, 3, "ab", "c"), ("y", 2, 4, "a", "bc"), (None, 2, 5, "a", "bc")], "country string, source int, id long, name_clean string, address_clean string")
    got = roles.truth(rows.where("source = 1"), rows.where("source > 1"))
    assert [tuple(r) for r in got.collect()] == [("x", 1, 2, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("address_clean" not in x for x in plan.splitlines() if "Exchange" in x or "Join" in x)


def test_no_pair_fetches_its_texts(spark, monkeypatch):
    """The features of names and addresses equal those of fetched texts."""
    s1, pool = roles.sides(spark, "/root/testdata/sf0.001")
    pairs = s1.select("country", F.col("id").alias("s1")).join(pool.select("country", "source", "id"), "country").where("pmod(hash(s1, id), 40) = 0 or s1 = 3").select(*features.PAIR)
    pairs = tables.stage(pairs, "pairs")
    names = [*features.NAME_FEATURES, *features.ADDRESS_FEATURES]
    fetched = features.fuzzy_features(features.set_features(features.pair_records(pairs, s1, pool))).join(features.idf_cosines(pairs, s1, pool), list(features.PAIR))
    expected = {tuple(r)[:4]: tuple(r)[4:] for r in fetched.select(*features.PAIR, *names).collect()}
    monkeypatch.setattr(features, "pair_records", None)
    monkeypatch.setattr(features, "text_features", partial(features.text_features, held=8))
    rivals = spark.createDataFrame([], "country string, source int, id long, best double, second double")
    rows = features.all_features(pairs.withColumns({"rrf": F.lit(0.1), "rank": F.lit(1)}), rivals, s1, pool)
    found = {tuple(r)[:4]: tuple(r)[4:] for r in rows.select(*features.PAIR, *names).collect()}
    assert set(found) == set(expected) and len(found) == pairs.count() > 50
    for k, v in expected.items():
        assert found[k] == pytest.approx(v, abs=1e-12), k


def test_common_subsequences_equal_the_table():
    rng = random.Random(5)
    for _ in range(400):
        a, b = ("".join(rng.choice("abcé\U0001f600 ") for _ in range(rng.choice((0, 1, 5, 70, 200)))) for _ in range(2))
        a, b = (a[:50] + b[20:], b) if rng.random() < 0.3 else (a, b)
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        assert fuzzy.lcs_length(a, b) == row[-1]
