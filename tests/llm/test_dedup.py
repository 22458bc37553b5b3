import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tessera.llm import exact_dedup, minhash, substring_dedup
from tessera.llm.components import connected_components

WORDS = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id string, n string, key string")


def rows_of(pairs):
    return [(i, t, "k", "n", "y") for i, t in pairs]


def test_exact_groups_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["", None, "a", "é" * 40, "x" * 64, "x" * 65, "x" * 1100 + "y", "x" * 1100 + "z", "q" * 20000, "q" * 19999 + "r"]
    pairs = [(i, rng.choice(base)) for i in range(120)]
    out = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, rows_of(pairs))).collect()}
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    for i, t in pairs:
        own = groups[t or ""]
        assert (out[i].keep_id, out[i].group_size, out[i].kept) == (max(own), len(own), i == max(own))


def test_exact_groups_with_repeated_and_null_ids(spark):
    long_a, long_b = "a" * 64 + "x" * 100, "b" * 64 + "x" * 100
    pairs = [(5, long_a), (5, long_b), (4, long_a), (4, long_b), (7, "t"), (7, "t"), (None, "u"), (None, "t")]
    out = Counter((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_groups(frame(spark, rows_of(pairs))).collect())
    assert out == Counter({(5, 5, 2): 2, (4, 5, 2): 2, (7, 7, 3): 2, (None, None, 1): 1, (None, 7, 3): 1})
    left = exact_dedup.drop_copies(frame(spark, rows_of([(7, "t"), (7, "t"), (6, "t"), (None, "u")])))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, "u"), (7, "t")]
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def jaccard_components(pairs, k, percent=80):
    sets = {}
    for i, t in pairs:
        words = (t or "").encode().lower().split()
        size = min(k, len(words))
        sets[i] = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, n, words, edits):
    base = [rng.choice(WORDS) for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = rng.choice(WORDS) + "e"
        yield " ".join(own)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [*family(rng, 60, 120, 14), *family(rng, 25, 60, 9), *family(rng, 5, 3, 1), "", None, " \n", "One", "one", "ONE two", "é É", "É é", *[" ".join(rng.choice(WORDS) for _ in range(50)) for _ in range(30)]]
    pairs = list(enumerate(texts))
    for k in (2, 5):
        expected = jaccard_components(pairs, k)
        out = minhash.near_duplicates(frame(spark, rows_of(pairs)), shingle=k).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicates_at_the_edges(spark):
    same = "one two three four five six"
    out = minhash.near_duplicates(frame(spark, rows_of([(3, same), (3, same), (9, same), (None, same), (4, "")]))).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in out) == Counter({(3, 3, True): 1, (9, 3, False): 1, (None, None, True): 1, (4, 4, True): 1})
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    left = minhash.keep_one_of_each(frame(spark, rows_of([(3, same), (9, same), (None, same)])))
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3]


def test_sketch_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    names = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    for shared in (0.5, 0.8):
        n = int(1000 * 2 * shared / (1 + shared))
        a, b = names[:1000], np.concatenate([names[:n], names[1000 : 2000 - n]])
        equal = (minhash.sketch(np.sort(a), 2400) == minhash.sketch(np.sort(b), 2400)).mean()
        assert abs(equal - shared) < 0.06
    for n in (1, 2, 7, 100):
        assert not (minhash.sketch(names[:n], 240) == minhash._UNFILLED).any()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (20, 21), (21, 20), (5, 5)] + [(i, i + 1) for i in range(100, 160)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out[3] == 1 and out[9] == 7 and out[21] == 20 and all(out[i] == 100 for i in range(100, 161)) and 5 not in out


def test_chains_equal_brute_force():
    rng = random.Random(2)
    k, cost = 8, 0.1
    for trial in range(300):
        n, most = rng.randint(1, 8), 40 if trial % 2 else 16
        a, b = [rng.randint(0, most) for _ in range(n)], [rng.randint(0, most) for _ in range(n)]

        def score(chain):
            total = float(k)
            for i, j in zip(chain, chain[1:]):
                total += min(k, a[j] - a[i], b[j] - b[i]) - cost * (a[j] - a[i] + b[j] - b[i])
            return total

        def rising(order):
            return all(a[i] < a[j] and b[i] < b[j] for i, j in zip(order, order[1:]))

        best = float("-inf")
        for bits in range(1, 1 << n):
            chain = sorted((i for i in range(n) if bits >> i & 1), key=lambda i: a[i])
            if rising(chain):
                best = max(best, score(chain))
        found = substring_dedup.chains(a, b, k, cost)
        assert all(rising(c) for c in found) and sorted(i for c in found for i in c) == list(range(n))
        # Best predecessors are chosen by place, so the gain of overlapping seeds may fall short a little.
        assert abs(score(found[0]) - best) < 1e-9


def passage(rng, n):
    return [rng.choice(WORDS) + rng.choice("abc") + str(rng.randint(0, 99)) for _ in range(n)]


def test_matches_cover_every_place():
    rng = np.random.default_rng(4)
    for n in (3, 40):
        x, y = (np.array(rng.integers(0, 4, n), np.int64) for _ in range(2))
        a, b = substring_dedup.matches((x, np.arange(n, dtype=np.int32)), (y, np.arange(n, dtype=np.int32)))
        assert all(x[i] == y[j] for i, j in zip(a, b))
        assert set(a) == {i for i in range(n) if x[i] in y} and set(b) == {j for j in range(n) if y[j] in x}


def test_long_texts_are_aligned_to_their_ends():
    rng = random.Random(3)
    base = [rng.randrange(1 << 30) for _ in range(30_000)]
    other = [-1, *base[:4000], *[rng.randrange(1 << 30) for _ in range(1500)], *base[5500:]]
    # Only one seed is known, far from both ends.
    assert substring_dedup.align(base, other, [(9000, 9001), (9010, 9011)]) == [(5500, 30_000, 5501, 30_001)]
    assert substring_dedup.align(base, other, [(100, 101), (110, 111)]) == [(0, 4000, 1, 4001)]
    gap = substring_dedup.align(base, other, [(2000, 2001), (7000, 7001)])
    assert gap == [(0, 30_000, 1, 30_001)]


def test_fuzzy_passages(spark):
    """Recall by the distance of changed words: 7 (86 % equal), 8 and 10 in passages of 100 words."""
    rng = random.Random(6)
    rows, pairs = [], {7: [], 8: [], 10: []}
    for every, found in pairs.items():
        for _ in range(20):
            base = passage(rng, 100)
            changed = [w + "x" if k % every == 3 else w for k, w in enumerate(base)]
            i = len(rows)
            rows += [(i, " ".join(passage(rng, 30) + base + passage(rng, 30))), (i + 1, " ".join(passage(rng, 20) + changed + passage(rng, 40)))]
            found.append((i, i + 1))
    rows += [(len(rows) + k, " ".join(passage(rng, 150))) for k in range(40)]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows_of(rows))).collect()}
    assert set(out) <= {i for found in pairs.values() for x in found for i in x}
    recall = {every: sum(x in out and y in out and out[x].repeated_words >= 85 for x, y in found) / len(found) for every, found in pairs.items()}
    assert recall[7] >= 0.5 and recall[8] >= 0.85 and recall[10] == 1.0


def test_classes_hold_all_links(spark):
    rng = random.Random(9)
    one, two = passage(rng, 70), passage(rng, 60)
    texts = [one + passage(rng, 40), passage(rng, 20) + one + two, two + one + passage(rng, 9) + one, passage(rng, 90), two + passage(rng, 80)]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows_of((i, " ".join(t)) for i, t in enumerate(texts)))).collect()}
    member = {i: set(r.shared) for i, r in out.items()}
    linked = {(i, j) for i in out for j in out if i < j and member[i] & member[j]}
    assert linked == {(0, 1), (0, 2), (1, 2), (1, 4), (2, 4)}
    assert [(p.start, p.end) for p in out[2].passages] == [(0, 130), (139, 209)]


def test_passage_pieced_together_from_other_texts(spark):
    """All seeds of the two texts' passage stand in texts of smaller ids, none of which shares 16 words with them."""
    rng = random.Random(12)
    shared = passage(rng, 60)
    texts = {n: passage(rng, 40) + shared[i : i + 15] + passage(rng, 40) for n, i in enumerate(range(0, 46, 5))}
    texts |= {10: passage(rng, 25) + shared + passage(rng, 30), 11: shared + passage(rng, 70)}
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows_of((i, " ".join(t)) for i, t in texts.items()))).collect()}
    assert set(out) == {10, 11} and set(out[10].shared) & set(out[11].shared)
    assert [(p.start, p.end) for r in (out[10], out[11]) for p in r.passages] == [(25, 85), (0, 60)]


def test_one_match_is_aligned():
    """A pair that a long seed makes may have one match only, in 16 equal words."""
    rng = random.Random(2)
    run = substring_dedup._aligned(6, 6, 0.1, 0.7, 16)
    for _ in range(300):
        same = [rng.randrange(1 << 32) for _ in range(16)]
        x, y = ([rng.randrange(1 << 32) for _ in range(20)] + same + [rng.randrange(1 << 32) for _ in range(20)] for _ in range(2))
        codes = [pa.array([np.array(t, np.uint32).tobytes()]) for t in (x, y)]
        (out,) = run([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), *codes], names=["a", "b", "codes_a", "codes_b"])])
        assert out.to_pylist() == [{"a": 1, "b": 2, "a_start": 20, "a_end": 36, "b_start": 20, "b_end": 36}]


def test_seeds_equal_brute_force():
    """Leftmost of the least shingles of each full window, text by text; one window for a shorter text."""
    rng = random.Random(7)
    texts = [None, "", " \n", "  A b\x0bc ", *(" ".join(rng.choice("aBcé"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 60))) for _ in range(200))]
    codes, bounds = substring_dedup.word_codes(pa.array(texts))
    kinds = [(2, 3), (3, 1), (4, 6)]
    for (k, window), (hashes, places, begin) in zip(kinds, substring_dedup.seeds(codes, bounds, kinds)):
        names = {}
        for t, text in enumerate(texts):
            words = (text or "").encode().lower().split()
            own, at = hashes[begin[t] : begin[t + 1]].tolist(), places[begin[t] : begin[t + 1]].tolist()
            # A shingle that is no seed anywhere has no known hash, so every shingle is hashed on its own.
            shingles = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
            for x in set(shingles) - set(names):
                one = substring_dedup.word_codes(pa.array([b" ".join(x).decode()]))
                names[x] = int(substring_dedup.seeds(*one, [(k, window)])[0][0][0])
            h = [names[x] for x in shingles]
            least = {min(range(i, min(i + window, len(h))), key=lambda j: (h[j] % 2**64, j)) for i in range(max(1, len(h) - window + 1)) if h}
            assert at == sorted(least) and own == [h[j] for j in at]


def test_each_seed_is_shuffled_once(spark, monkeypatch):
    """Neither for its anchor and for the pairs anew, nor in a list of all seeds of a text."""
    plans, write = [], substring_dedup.materialize
    monkeypatch.setattr(substring_dedup, "materialize", lambda df, label="step": plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    rng = random.Random(5)
    shared = passage(rng, 60)
    substring_dedup.shared_passages(frame(spark, rows_of((i, " ".join(shared + passage(rng, 30))) for i in range(4))))
    assert sum("Exchange hashpartitioning(hash#" in line for plan in plans for line in plan.splitlines()) == 1
    assert not any("hashes#" in plan and "SortMergeJoin [digest#" in plan for plan in plans)


def test_copies_and_ids_on_several_texts(spark):
    rng = random.Random(14)
    shared, other = passage(rng, 70), passage(rng, 60)
    texts = sorted((" ".join(passage(rng, 20) + x) for x in (shared, other)), key=lambda t: hashlib.blake2b(t.encode(), digest_size=16).digest())
    # Id 1 goes by the first of its two texts; 4 and 6 share the passage of the second one with each other only.
    first, second = (shared, other) if texts[0].endswith(" ".join(shared)) else (other, shared)
    rows = [(1, texts[0]), (1, texts[1]), (2, " ".join(first + passage(rng, 20))), (4, " ".join(second)), (6, " ".join(second + passage(rng, 30)))]
    rows += [(i, rows[2][1]) for i in range(10, 40)]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows_of(rows))).where("doc_id <> 1").collect()}
    member = {i: set(r.shared) for i, r in out.items()}
    assert set(out) == {2, 4, 6, *range(10, 40)} and all(out[i].class_id == 2 and out[i].n_copies == 31 for i in range(10, 40))
    assert member[4] & member[6] and not member[2] & member[4] and {out[i].n_links for i in (2, 4, 6)} == {1}


def test_clashing_columns(spark):
    rows = [(1, "a b c d e f", "x", 1, "y"), (2, "a b c d e f", "x", 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, gone_ int, digest string")
    for keep, left in ((exact_dedup.drop_copies, 2), (minhash.keep_one_of_each, 1)):
        assert [r.doc_id for r in keep(docs).collect()] == [left] and keep(docs).columns == docs.columns
    assert substring_dedup.repeated_passages(docs).count() == 0


def test_repeated_passages(spark):
    rng = random.Random(8)
    shared, fuzzy = passage(rng, 80), passage(rng, 90)
    changed = list(fuzzy)
    changed[30], changed[60] = "other", "another"
    del changed[45]
    texts = {
        1: passage(rng, 40) + shared + passage(rng, 50),
        2: shared + passage(rng, 120),
        3: passage(rng, 33) + fuzzy,
        4: changed + passage(rng, 20),
        5: passage(rng, 300),
        6: passage(rng, 30) + shared[:30] + passage(rng, 30),
        7: passage(rng, 60),
        9: "",
        10: "few words",
        12: "few words",
    }
    rows = [(i, t if isinstance(t, str) else " ".join(t)) for i, t in texts.items()] + [(8, " ".join(texts[7])), (8, " ".join(texts[7])), (11, None), (None, " ".join(shared))]
    out = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows_of(rows))).collect()}
    assert set(out) == {1, 2, 3, 4, 7, 8}
    spans = {i: [(p.start, p.end) for p in r.passages] for i, r in out.items()}
    assert spans[1] == [(40, 120)] and spans[2] == [(0, 80)] and spans[3] == [(33, 123)] and spans[4] == [(0, 89)]
    assert spans[7] == spans[8] == [(0, 60)] and out[8].class_id == 7 and out[8].n_copies == 2
    assert substring_dedup.repeated_passages(frame(spark, [])).count() == 0
