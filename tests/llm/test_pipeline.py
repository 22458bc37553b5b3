import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, quality_rules

from .test_dedup import jaccard_components
from .test_rules import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(15, 120)) for _ in range(260)]
    texts += [texts[rng.randrange(200)] for _ in range(30)]
    texts += [" ".join([*t.split()[:-1], "changed"]) for t in texts[:20]]
    texts += ["few words", None, "", " ".join(w + "###" for w in texts[0].split()), "a b c d e " * 9, texts[5]]
    rows = [(i, t, rng.choice(["en", "de"]), f"src{rng.choice([0, 0, 1, 2])}", len(t or "")) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def test_pipeline_equals_brute_force(spark, folder):
    import public_tokenizers
    import tokenizers

    import corpus_pipeline

    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    sound = {r.doc_id for r in quality_rules.quality_verdicts(docs).collect() if r.kept}
    assert not {i for i, t, *_ in rows if len((t or "").split()) < 10} & sound and len(sound) > 280
    largest = {}
    for i, t, *_ in rows:
        if i in sound:
            largest[t] = max(i, largest.get(t, -1))
    unique = set(largest.values())
    components = jaccard_components([(i, t) for i, t, *_ in rows if i in unique], 5)
    kept = {i for i, (_, c) in components.items() if i == c}
    assert len(sound) > len(unique) > len(kept)
    left = docs.where(docs.doc_id.isin(sorted(kept)))
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {i: t for i, t, *_ in rows}
    # The whole order: documents by position, then id, then copy.
    places = sorted((p, r.doc_id, k) for r in mixing.mix(left).collect() for k, p in enumerate(r.positions))
    expected = []
    for _, i, k in places:
        ids = library.encode(text[i], add_special_tokens=False).ids
        expected.append((i, k + 1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        out = corpus_pipeline.run(spark, path).orderBy("training_order").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [(r.doc_id, r.copy, r.n_tokens, r.ids_sha256) for r in out] == expected


def test_stages_keep_the_columns(spark, folder):
    import corpus_pipeline

    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "mixing", "bpe"]
    extra = docs.withColumns({c: F.lit("x") for c in ("gone", "whole_row", "position", "id", "place", "group")})
    twice = extra.where("doc_id < 40").union(extra.where("doc_id < 3")).union(extra.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, twice, path).columns == twice.columns
        assert stage(spark, twice, path).where("doc_id is not null").count() > 0
        assert stage(spark, docs.limit(0), path).count() == 0
    assert corpus_pipeline.encoding_stage(spark, twice, path).where("training_order is null").count() == twice.count()
    assert corpus_pipeline.encoding_stage(spark, docs.limit(0), path).count() == 0
