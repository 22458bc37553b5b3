import random
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import html_text, language_id, mixing, pii, quality_classifier, quality_rules

WORDS = [f"{a}{b}{c}" for a in "bcdfgst" for b in "aeiou" for c in "lmnrst"]


def prose(rng, n):
    out = []
    while len(out) < n:
        line = [rng.choice(WORDS) for _ in range(rng.randint(5, 12))]
        out += [line[0].capitalize(), *line[1:-1], line[-1] + "."]
    return " ".join(out[:n])


# Quality rules


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_counts_equal_brute_force():
    rng = random.Random(4)
    texts = ["", None, " \t\x0b", "a b c d e a b c d e", "a a a a a a a", "x\nx\n \n \ny x", "é ü # $ |\x85z", "one two three four five one two three four"]
    texts += ["".join(rng.choice("ab \n#é") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    for t in texts:
        assert quality_rules.text_statistics(t or "")[:5] == counts(t)


def test_quality_verdicts(spark):
    rng = random.Random(6)
    rows = [(i, "en", rng.choice(["a", "b"]), prose(rng, rng.randint(30, 400)), "x") for i in range(400)]
    symbols = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, 200).split())
    rows += [(1000, "en", "a", symbols, "x"), (1001, "en", "b", prose(rng, 200).upper(), "x"), (1002, "en", "a", "too few words", "x"), (1003, None, None, prose(rng, 100), "x"), (1004, None, None, None, "x"), (1005, "en", "a", "", "x"), (0, "en", rows[0][2], rows[0][3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, `group` string")
    out = quality_rules.quality_verdicts(docs).collect()
    assert len(out) == len(rows) and {r.doc_id for r in out if r.base_failed} == {1002, 1004, 1005}
    assert {r.doc_id for r in out if not r.kept} == {1000, 1001, 1002, 1004, 1005}
    for r in out[:50]:
        text = next(t for i, _, _, t, _ in rows if i == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
    assert quality_rules.keep_sound(docs).count() == len(rows) - 5
    assert quality_rules.quality_verdicts(docs.limit(0)).count() == 0
    few = quality_rules.quality_verdicts(docs.where("doc_id < 20")).collect()
    assert all(r.distance is None and r.kept != r.base_failed for r in few)


def test_small_groups_keep_their_clean_documents(spark):
    rng = random.Random(8)
    rows = [(i, "en", "a", prose(rng, rng.randint(30, 400))) for i in range(300)]
    long_words = lambda: " ".join("".join(rng.choice(WORDS) for _ in range(6)) for _ in range(rng.randint(30, 100)))
    rows += [(1000 + i, "th", "b", long_words()) for i in range(60)] + [(2000, "th", "b", prose(rng, 200).upper())]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    assert {r.doc_id for r in quality_rules.quality_verdicts(docs).collect() if not r.kept} == {2000}


def random_start_mcd(x, trials, seed):
    """The classical search: concentration from many random cores of d + 1 rows, to the end; all in plain numpy."""
    rng, ridge = np.random.default_rng(seed), np.diag(np.square(quality_rules.RIDGE))
    n, d = x.shape
    h, best = (n + d + 1) // 2, None
    for _ in range(trials):
        core = x[rng.choice(n, d + 1, replace=False)]
        then = np.inf
        while True:
            mean, cov = core.mean(0), np.cov(core.T, bias=True) + ridge
            now = np.linalg.slogdet(cov)[1]
            if now > then - 1e-9:
                break
            then = now
            away = x - mean
            core = x[np.argsort(np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away))[:h]]
        if best is None or now < best[0]:
            best = now, mean, cov
    return best


def judged_by_hand(x, raw):
    """Reweighted estimate and squared distances, from the definition."""
    _, mean, cov = raw
    away = x - mean
    d2 = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
    inside = x[d2 <= 14.4494 * np.median(d2) / 5.3481]
    mean, cov = inside.mean(0), np.cov(inside.T, bias=True) * 0.975 / 0.92921 + np.diag(np.square(quality_rules.FLOOR))
    away = x - mean
    return mean, np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)


def test_estimates_equal_a_random_search(spark):
    """Group a has 30 % far off in one place, group b 40 % (and several blocks), group c is clean."""
    rng = np.random.default_rng(3)
    d = len(quality_rules.FEATURES)
    groups = {"a": (600, 180, 9.0), "b": (5000, 2000, 12.0), "c": (300, 0, 0.0)}
    tables, rows = {}, []
    for name, (n, bad, far) in groups.items():
        x = rng.normal(size=(n, d)) @ (np.eye(d) + 0.4 * rng.normal(size=(d, d)))
        x[:bad] = x[:bad] + far * (1 + np.arange(d) % 3)
        tables[name] = x
        rows += [(name, hash((name, k)), *map(float, r)) for k, r in enumerate(x)]
    vectors = spark.createDataFrame(rows, "`group` string, spread long, " + ", ".join(f"{f} double" for f in quality_rules.FEATURES))
    sizes = spark.createDataFrame([(g, len(x)) for g, x in tables.items()], "`group` string, n_group long")
    found = {r.group: r for r in quality_rules.robust_estimates(vectors, sizes).collect()}
    for name, x in tables.items():
        raw = random_start_mcd(x, 60, 5)
        assert found[name].log_det <= raw[0] + 0.05
        mean, d2 = judged_by_hand(x, raw)
        e = np.array(found[name].estimate)
        away = x - e[:d]
        own = np.einsum("ij,jk,ik->i", away, quality_rules._square(e[d : d + d * (d + 1) // 2]), away)
        assert np.allclose(e[:d], mean, atol=0.1) and np.corrcoef(own, d2)[0, 1] > 0.98
        bad = groups[name][1]
        assert ((own > quality_rules.CUTOFF) == (d2 > quality_rules.CUTOFF)).mean() > 0.998
        assert not bad or own[:bad].min() > quality_rules.CUTOFF
        assert (own[bad:] > quality_rules.CUTOFF).mean() < 0.005


def test_chi2():
    assert abs(quality_rules._chi2_quantile(0.975, 6) - 14.4494) < 1e-3 and abs(quality_rules._chi2_quantile(0.5, 6) - 5.3481) < 1e-3
    assert abs(quality_rules._chi2(14.4494, 8) - 0.9292) < 1e-3


def test_a_source_of_two_fifths_junk(spark):
    rng = random.Random(10)
    loud = lambda: " ".join(w + rng.choice(["###", "$$$"]) for w in prose(rng, rng.randint(40, 200)).upper().split())
    rows = [(i, "en", f"s{i % 2}", loud() if i % 5 < 2 and i % 2 else prose(rng, rng.randint(40, 200)), "x") for i in range(1200)]
    rows += [(5000, "en", "s0", prose(rng, 50_000), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, gone string")
    out = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs).collect()}
    assert len(out) == 1201 and all(out[i] == ("#" not in t and "$" not in t) for i, _, _, t, _ in rows[:-1])
    left = quality_rules.keep_sound(docs)
    assert left.columns == docs.columns and left.count() == sum(out.values())


# Mixing


def target_by_hand(sizes, weights=(5, 2, 1), budget=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = budget * sum(sizes.values()), {}, set(names)
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > cap * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix(spark):
    rng = random.Random(9)
    sources = ["a", "b", "B", "é", None, "zero"]
    rows = [(i, prose(rng, rng.randint(1, 60)), s, "x") for i in range(3000) if (s := rng.choice([*["a"] * 8, *sources[1:5]])) or True]
    rows += [(5001, None, "a", "x"), (5002, "", "zero", "x"), (5003, " ", "zero", "x"), (None, "one two", "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mix(docs).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = target_by_hand(sizes)
    by_id = {i: (len((t or "").split()), s) for i, t, s, _ in rows}
    taken = Counter()
    assert len(out) == len(rows)
    for r in out:
        size, source = by_id[r.doc_id]
        assert r["size"] == size and r.source_size == sizes[source] and abs(r.target - targets[source]) < 1e-6 * max(1, targets[source])
        assert r.taken == size * r.copies <= 2 * size and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions)
        taken[source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(120, 0.02 * t)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.taken, r.positions)
    assert sorted(map(key, out)) == sorted(map(key, again))
    ordered = mixing.in_training_order(docs)
    assert ordered.columns == docs.columns and ordered.count() == sum(r.copies for r in out)
    clash = docs.withColumnsRenamed({"size": "whole_row"}).withColumn("position", F.lit(1))
    assert mixing.in_training_order(clash).columns == clash.columns
    early = {s: np.mean([p for r in out if by_id[r.doc_id][1] == s for p in r.positions]) for s in ("B", "b")}
    # Rising density for the first source in order, falling for every third one.
    assert early["B"] > 0.54 and early["b"] < 0.46
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.in_training_order(docs.limit(0)).count() == 0


def test_stored_order(spark, tmp_path):
    """Files of very unequal sizes, which Spark reads in another order than they were written in."""
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 9) ** 4 * 40) for i in range(5000)]
    sizes = spark.createDataFrame(rows, "i long, n int").select("i", F.repeat(F.sha2(F.col("i").cast("string"), 512), F.col("n") / 128).alias("text"))
    parts = [sizes.where(f"i >= {a} and i < {b}").coalesce(1) for a, b in ((0, 10), (10, 2000), (2000, 2001), (2001, 2100), (2100, 4000), (4000, 4001), (4001, 4950), (4950, 5000))]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    whole.write.parquet(f"{tmp_path}/sorted")
    back = mixing.stored_order(spark.read.parquet(f"{tmp_path}/sorted"), "place")
    assert [r.i for r in back.orderBy("place").select("i").collect()] == list(range(5000)) and back.columns == ["i", "text", "place"]
    assert mixing.stored_order(sizes.limit(3), "place").where("place is null").count() == 3


# Personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def spans_by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in re.findall("[0-9]", m[0])]
            luhn = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def base(text):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(text))


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    cases = ["a@b.c", "x@y", "a@@b.c", "a.b@c.d.e_f@g.h", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", "é+49 30 1234567 ü a@b.de"]
    cases += ["".join(rng.choice("a1.@-+ _()23") for _ in range(rng.randint(1, 50))) for _ in range(5000)]
    assert all(base(t) == spans_by_pattern(t) for t in cases)
    assert base("1" * 100_000 + "a" * 100_000 + "@") == ""


def test_disclosing_terms(spark):
    rng = random.Random(3)
    mail = "who@example.org"
    rows = [(i, prose(rng, 30), "x") for i in range(60)]
    rows += [(100, f"write to zorblatt {mail} the bas", "x"), (101, f"zorblatt is at {mail} in bas", "x"), *[(110 + k, f"bas and the and is {k}", "x") for k in range(5)], (102, "bas and the and is", "x"), (103, None, "x"), (104, "", "x"), (101, f"zorblatt is at {mail} in bas", "x"), (None, "no id " + mail, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    out = pii.find_personal_data(docs)
    found = {}
    for r in out.withColumn("spans", pii.span_list()).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len(found[101]) == 2 and found[101][0].spans == found[101][1].spans
    text = dict((i, t) for i, t, _ in rows)
    terms = {text[100][t.start : t.end] for t in found[100][0].terms}
    assert "zorblatt" in terms and "bas" not in terms
    assert found[103][0].spans == found[104][0].spans == "" and found[5][0].n_email == 0
    assert found[100][0].spans.startswith("email:18:33,term:")
    clean = {r.doc_id: r.text for r in pii.sanitised_documents(docs).collect()}
    assert mail not in clean[100] and "zorblatt" not in clean[100] and clean[5] == text[5] and clean[103] is None
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_disclosing_terms_far_from_the_entity(spark):
    rng = random.Random(4)
    mail = "who@example.org"
    rows = [(i, prose(rng, 30)) for i in range(60)]
    rows += [(100 + i, f"Zorblatt {prose(rng, 20)} zorblatt {prose(rng, 20)} {mail}") for i in range(3)] + [(200, f"{prose(rng, 15)} zorblatt {prose(rng, 15)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    found = {r.doc_id: [text[r.doc_id][t.start : t.end].lower() for t in r.terms] for r in pii.find_personal_data(docs).collect()}
    assert all(found[100 + i].count("zorblatt") == 2 for i in range(3)) and found[200] == ["zorblatt"]
    assert not any(found[i] for i in range(60) if "zorblatt" not in text[i])
    assert not any("zorblatt" in r.text.lower() for r in pii.sanitised_documents(docs).collect())


def test_terms_equal_brute_force(spark):
    """Every count from its definition, over distinct texts."""
    rng = random.Random(5)
    names = [f"n{a}{b}" for a in "abcdefgh" for b in "xyzw"]
    people = [(rng.sample(names, 2), f"{a}@{d}.org", f"10.0.{i}.7") for i, (a, d) in enumerate((a, d) for a in ("ann", "bob", "cyd") for d in ("one", "two"))]
    texts = []
    for i in range(160):
        words = prose(rng, rng.randint(3, 12)).split()
        if i % 4 == 0:
            (first, last), mail, ip = rng.choice(people)
            words += [first, last.upper(), rng.choice([mail, ip, "plain"])]
        texts.append(" ".join(words))
    texts += rng.choices(texts, k=60) + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    distinct = sorted({t or "" for t in texts})
    total = len(distinct)
    terms, entities = {}, {}
    for t in distinct:
        spans = pii.base_spans(t)
        inside = {k for _, s, e in spans for k in range(s, e)}
        entities[t] = pii._entities(t, spans)
        terms[t] = {m[0].lower() for m in re.finditer(r"[^\W\d_]{2,}", t)}, {m[0].lower() for m in re.finditer(r"[^\W\d_]{2,}", t) if not inside & set(range(*m.span()))}
    found = {}
    for e in set().union(*entities.values()):
        holders = [t for t in distinct if e in entities[t]]
        p = len(holders) / total
        for w in set().union(*(terms[t][0] for t in holders)):
            n, both = sum(w in terms[t][0] for t in distinct), sum(w in terms[t][0] for t in holders)
            bits = -np.log2(p) - np.log2((both + p) / (n + 1) / p)
            allowed = pii.OF_KIND if e % 2 == 0 else pii.GENERALISE
            if bits <= allowed:
                found[w] = found.get(w, False) or bits <= min(allowed, pii.REMOVE)
    for r in pii.find_personal_data(docs).collect():
        t = texts[r.doc_id] or ""
        inside = {k for _, s, e in pii.base_spans(t) for k in range(s, e)}
        expected = [(*m.span(), found[m[0].lower()]) for m in re.finditer(r"[^\W\d_]{2,}", t) if m[0].lower() in found and not inside & set(range(*m.span()))]
        assert [(x.start, x.end, x.removed) for x in r.terms] == expected
    assert found and any(found.values())


def test_planted_names(spark):
    """Names that stand with an address in one to four texts, one of them without it now and then: recall and what else is marked."""
    rng = random.Random(12)
    common = [prose(rng, rng.randint(20, 60)) for _ in range(600)]
    planted, rows = set(), []
    for i in range(60):
        name = "".join(rng.choice("bdkmprtv") + rng.choice("aeo") for _ in range(4)) + "qu"
        planted.add(name)
        for _ in range(rng.randint(1, 4)):
            rows.append(f"{name.title()} {prose(rng, 25)} mail p{i}@host{i % 7}.net")
    rows = list(enumerate(common + rows + [f"{n} {prose(rng, 20)}" for n in sorted(planted)[:10]]))
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    marked = [rows[r.doc_id][1][t.start : t.end].lower() for r in out for t in r.terms]
    hit = planted & set(marked)
    assert len(hit) >= 0.9 * len(planted)
    assert sum(m in planted or m == "mail" for m in marked) >= 0.9 * len(marked)


def test_sanitised_documents_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.org x", "o", "k", "b"), (1, "nothing here", "o", "k", "b"), (None, "c@d.org", None, None, None), (2, None, "o", "k", "b")], "doc_id long, text string, own_id string, text_key string, base string")
    out = pii.sanitised_documents(docs)
    assert out.columns == docs.columns and out.count() == 4
    assert not any("@" in (r.text or "") for r in out.collect()) and out.where("text = 'nothing here'").count() == 1


def test_many_addresses_take_linear_time():
    text = " ".join(f"name{i}xy a{i}@b{i}.org" for i in range(40_000))
    began = time.time()
    assert len(list(pii._free_terms(text, pii.base_spans(text)))) == 80_000 and time.time() - began < 5


# Language


def test_language_by_held_out_accuracy(spark):
    rng = random.Random(7)
    sounds = {"aa": ["ka", "lo", "mi", "na", "po"], "bb": ["sch", "ung", "ber", "eit", "ich"], "cc": ["eau", "oux", "tre", "ment", "ille"]}
    make = lambda lang: " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30))
    rows = [(i, make(lang), lang, "x") for i in range(300) for lang in [rng.choice(list(sounds))]]
    rows += [(900, None, "aa", "x"), (901, "123 !", "bb", "x"), (902, "", None, "x"), (903, rows[0][1], None, "x"), (None, rows[0][1], "aa", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = {r.doc_id: r for r in language_id.predict(docs, docs.where("doc_id < 200")).collect()}
    assert all(out[i].lang_pred == lang for i, _, lang, _ in rows[200:300]) and all(0 <= r.score <= 1 for r in out.values())
    assert [out[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and out[903].lang_pred == out[0].lang_pred
    none = language_id.predict(docs, docs.limit(0)).collect()
    assert {r.lang_pred for r in none} == {"und"} and language_id.predict(docs.limit(0), docs).count() == 0


def test_linear_form_equals_the_kernel_machine():
    rng = random.Random(1)
    texts, langs = [prose(rng, 20) if i % 2 else prose(rng, 20).replace("a", "y") for i in range(30)], ["p" if i % 2 else "q" for i in range(30)]
    rows = [language_id.presence(t) for t in texts]
    names, grams, matrix = language_id.fit(rows, langs, landmarks=12)
    x = np.zeros((30, language_id.SIZE), np.float32)
    for line, row in zip(x, rows):
        line[row] = 1 / np.sqrt(len(row))
    marks = x[np.linspace(0, 29, 12).astype(int)]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    ok = values > 1e-6 * values.max()
    f = (x @ marks.T) @ (vectors[:, ok] / np.sqrt(values[ok]))
    y = np.where(np.array(langs)[:, None] == np.array(names)[None], 1.0, -1.0)
    w = np.linalg.solve(f.T @ f + language_id.RIDGE * 30 / 2 * np.eye(f.shape[1]), f.T @ y)
    lookup = np.full(language_id.SIZE, -1, np.int32)
    lookup[grams] = np.arange(len(grams))
    assert np.allclose(language_id.scores(rows, lookup, matrix), f @ w, atol=1e-3)


def test_presence_of_short_and_long_texts():
    rng = random.Random(2)
    for n in (1, 50, 4000, 40_000):
        text = "".join(rng.choice("abcdeé ,1") for _ in range(n)) + "z"
        plain = re.sub(r"[^a-zé]+", " ", f" {text} ")
        got = language_id.presence(text)
        assert len(set(got.tolist())) == len(got)
        grams = {plain[i : i + k] for k in range(1, 5) for i in range(len(plain) - k + 1)}
        assert len(grams) * 0.99 <= len(got) <= len(grams)


def test_very_long_texts_keep_their_language(spark):
    """A million characters of a script with 3,000 letters, after learning from short texts."""
    rng = random.Random(3)
    letters = {"one": [chr(0x4E00 + i) for i in range(3000)], "two": [chr(0x4E00 + i) for i in range(1500, 4500)]}
    make = lambda lang, n: "".join(letters[lang][min(2999, int(rng.paretovariate(0.7)))] for _ in range(n))
    rows = [(i, make(("one", "two")[i % 2], 400), ("one", "two")[i % 2]) for i in range(80)] + [(100, make("one", 1_000_000), None), (101, make("two", 1_000_000), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r.lang_pred for r in language_id.predict(docs, docs).collect()}
    assert (out[100], out[101]) == ("one", "two")
    # Ties and bounds: one n-gram budget for all, and one id on two texts.
    few = language_id.predict(docs, docs.union(docs), grams=3000).collect()
    assert len(few) == 82


# Classifier


def test_classifier_by_held_out_accuracy(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(500):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(20, 80))
        text = text if good else " ".join(w + rng.choice(["###", "$$$"]) for w in text.split())
        rows.append((i, text, "en", rng.choice("ab" if good else "bc"), len(text), "x"))
        if i % 2:
            labels.append((i, int(good)))
    truth = {i: "#" not in t and "$" not in t for i, t, *_ in rows}
    rows += [(900, None, None, None, None, "x"), (901, "", "en", "a", 0, "x"), (None, "text", "en", "a", 4, "x"), (7, "other text of an id", "en", "a", 4, "x"), (902, "word " * 100_000, "en", "a", 500_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    out = quality_classifier.score_quality(docs, known, picks=20).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    again = quality_classifier.score_quality(docs.repartition(7), known.repartition(3), picks=20).collect()
    plain = lambda found: sorted((str(r.doc_id), r.p_text, r.p_meta, r.score) for r in found)
    assert plain(out) == plain(again)
    unseen = [r for r in out if r.doc_id is not None and r.doc_id < 500 and r.doc_id % 2 == 0]
    assert np.mean([r.kept == truth[r.doc_id] for r in unseen]) > 0.97
    # The metadata alone tells a part of them: a comes with good ones only, c with bad ones.
    sides = [(r.p_meta > 0.5) == truth[r.doc_id] for r in unseen if rows[r.doc_id][3] != "b"]
    assert np.mean(sides) > 0.95
    for few in ("quality = 1", "quality = 1 or doc_id in (select max(doc_id) from known where quality = 0)"):
        known.createOrReplaceTempView("known")
        one = quality_classifier.score_quality(docs, spark.sql(f"select * from known where {few}")).collect()
        assert all(r.score is None and r.kept for r in one)
    assert quality_classifier.score_quality(docs.limit(0), known).count() == 0


# HTML


def test_layout():
    page = """<html><head><title>t</title><style>p{}</style></head><body><h1>Head <b>line</b></h1><p>One<p>Two &amp; three<br>four
      <ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul><div hidden>no</div><span style="DISPLAY: none">no</span>
      <table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td rowspan=2>r<td>1<tr><td>2</table>
      <div style="visibility:hidden">no<b style="visibility:visible">yes</b></div><pre> a\n  b</pre><script>var x = "</p>"</script><!-- c --> 1 < 2 </body>"""
    assert html_text.visible_text(page) == "Head line\n\nOne\n\nTwo & three\nfour\n\n- a\n- b\n  3. x\n  4. y\n\nName       Qty\nApple pie  3\nr          1\n           2\n\nyes\n\n a\n  b\n\n1 < 2"


def plain_lines(node, listed=False):
    """A second renderer, for trees of a few kinds of elements: (blank lines asked before, line) pairs, by plain recursion."""
    kind, parts = node
    if kind == "hidden":
        return []
    out, inline = [], []
    listed = kind in ("li", "ul") or listed and kind != "p"

    def flush():
        if inline:
            out.append((0, " ".join(inline)))
            inline.clear()

    for part in parts:
        if isinstance(part, str):
            inline.append(part)
            continue
        if part[0] == "b":
            inline.extend(line for _, line in plain_lines(part, listed))
            continue
        if part[0] == "hidden":
            continue
        flush()
        lines = plain_lines(part, listed)
        if part[0] in ("p", "ul", "quote"):
            gap = int(part[0] != "ul" or not listed)
            lines = [(gap, None), *lines, (gap, None)]
            if part[0] == "quote":
                lines = [(g, None if x is None else "  " + x if x else x) for g, x in lines]
        elif part[0] == "li" and lines:
            lines = lay(lines)
            lines = [(0, ("- " if i == 0 else "  ") + x if x or i == 0 else "") for i, x in enumerate(lines)]
        out.extend(lines)
    flush()
    return out if kind != "quote" else [(0, x) for x in lay(out)]


def lay(pairs):
    lines, gap = [], 0
    for g, x in pairs:
        gap = max(gap, g)
        if x is not None:
            if lines and gap:
                lines.append("")
            lines.append(x)
            gap = 0
    return lines


# An element that ends a p does so from inside a span too, so hidden ones in a p hold text only.


def random_tree(rng, depth, words, kind="div"):
    parts = []
    for _ in range(rng.randint(1, 4)):
        if rng.random() < 0.4 or depth == 0:
            if kind != "ul":
                words.append(f"w{len(words)}")
                parts.append(words[-1])
        else:
            child = "li" if kind == "ul" else rng.choice(["div", "div", "p", "b", "ul", "quote", "hidden"]) if kind not in ("p", "b") else rng.choice(["b", "hidden"])
            parts.append(random_tree(rng, 0 if child == "hidden" and kind in ("p", "b") else depth - 1, words, child))
    return kind, parts


def as_html(node):
    kind, parts = node
    tag = {"quote": "blockquote", "hidden": "span"}.get(kind, kind)
    return f"<{tag}{' hidden' * (kind == 'hidden')}>" + "".join(f" {p} " if isinstance(p, str) else as_html(p) for p in parts) + f"</{tag}>"


def test_layout_equals_a_plain_renderer():
    rng = random.Random(8)
    for _ in range(400):
        tree = random_tree(rng, rng.randint(1, 6), [])
        expected = "\n".join(lay(plain_lines(tree)))
        assert html_text.visible_text(as_html(tree)) == expected, as_html(tree)


def test_deep_pages():
    for depth in (149, 150, 10_000):
        assert html_text.visible_text("<div>" * depth + "<div hidden><p>secret</p></div>shown") == "shown"
        assert html_text.visible_text("<div>" * depth + "<table><tr><td>a<td>b<tr><td>ccc<td>d</table>") == "a    b\nccc  d"
        assert html_text.visible_text("<b>" * depth + "<dialog>closed</dialog><dialog open>open</dialog>") == "open"


def test_tables():
    wide = "x" * 300
    assert html_text.visible_text(f"<table><tr><td>{wide}<td>b<tr><td>a<td>c</table>") == f"{wide}  b\na{' ' * 301}c"
    assert html_text.visible_text("<table><tr><td>\u6771\u4eac<td>b<tr><td>abcdef<td>c</table>") == "\u6771\u4eac    b\nabcdef  c"
    assert html_text.visible_text("<table><tr><td colspan=2>ab<td>c<tr><td>d<td>e<td>f</table>") == "ab    c\nd  e  f"


def test_hostile_layout_takes_linear_time():
    pages = ["<table>" + "<tr><td colspan=1000 rowspan=60000>x" * 5000, "<blockquote>x" * 8000, "<ul><li>x" * 8000, "<table><tr><td>x" * 3000, "<p><button>" + "<b>" * 8000 + "<h1>z</h1>" * 8000, "<table><tr><td>" + "y" * 50_000 + "<td>b" + "<tr><td>a<td>b" * 5000]
    for page in pages:
        began = time.time()
        text = html_text.visible_text(page)
        assert time.time() - began < 5 and len(text) < 40 * len(page)


def test_all_visible_text_is_kept():
    rng = random.Random(5)
    tags = ["p", "div", "b", "ul", "li", "table", "tr", "td", "h2", "blockquote", "dl", "dd", "pre", "br", "ol"]
    for _ in range(300):
        words, page = [], []
        for k in range(rng.randint(1, 60)):
            if rng.random() < 0.5:
                page.append(rng.choice(["<{}>", "</{}>"]).format(rng.choice(tags)))
            else:
                words.append(f"w{k}")
                page.append(f" w{k} ")
        # Text between a table's tags comes before its rows, so only the words themselves are compared.
        assert sorted(html_text.visible_text("".join(page)).split()) == sorted([*words, *(x for x in html_text.visible_text("".join(page)).split() if not x.startswith("w"))])


def test_hostile_markup():
    for page in ("<", "<p", "<p a='", "<!--", "</", "<script>x", "&", "&#xD800;", "<div>" * 5000 + "deep", "<table>" * 300 + "in", "<td>" * 300, "<a b=" * 2000, "<textarea>&lt;b&gt;"):
        html_text.visible_text(page)
    assert html_text.visible_text("<div>" * 5000 + "deep") == "deep" and html_text.visible_text("<textarea>&lt;b&gt;") == "<b>"


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a", "x", "y"), (2, None, None, "x", "y"), (2, None, None, "x", "y"), (3, "v", "", None, None)], "page_id long, url string, html string, extracted string, _html string")
    out = sorted((r.page_id, r.extracted) for r in html_text.extract_text(pages).collect() if r.extracted is not None)
    assert out == [(1, "a"), (3, "")] and html_text.extract_text(pages).count() == 4 and html_text.extract_text(pages.limit(0)).count() == 0
