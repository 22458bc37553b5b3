import random

import numpy as np
import pytest

from tessera.llm import bpe


@pytest.fixture(scope="module")
def pair():
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.Tokenizer(path), tokenizers.Tokenizer.from_file(path)


def texts():
    rng = random.Random(1)
    yield from ["", " ", "a" * 3000, "it's THE end.\n\nΣΑΣ ΟΔΟΣ", "x<|endoftext|>y <|startoftext|>", "naïve café, 漢字 かな 🙂 é", "12345 3.14 #$%&&", "Ᲊ Ɤ ̀a"]
    for alphabet, n in (("abcdefghijklmnopqrstuvwxyz", 60), ("abe tion's 9!Iß\u0085漢🙂<|endoftext|>", 80)):
        for _ in range(400):
            yield "".join(rng.choice(alphabet) for _ in range(rng.randint(1, n)))


def test_encode_and_decode_equal_the_library(pair):
    own, library = pair
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(np.array(ids, np.int32)).decode() == library.decode(ids, skip_special_tokens=False)


def test_every_code_point_is_cut_alike(pair):
    own, library = pair
    points = [f"a{chr(c)}b {chr(c)}" for c in range(0x0, 0x11000, 3) if not 0xD800 <= c < 0xE000]
    assert [own.encode(t).tolist() for t in points] == [e.ids for e in library.encode_batch(points, add_special_tokens=False)]


def test_tables_may_be_emptied(pair, monkeypatch):
    own, library = pair
    monkeypatch.setattr(bpe, "WORD_TABLE", 3)
    monkeypatch.setattr(bpe, "PAIR_TABLE", 3)
    text = "some words that are encoded with tables of three entries, all of them different"
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, pair):
    import public_tokenizers

    rows = [(1, "Some text", "x"), (2, None, "y"), (2, "", "y"), (None, "Some text", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, with_text=True).collect()
    assert sorted(r.n_tokens for r in out) == [0, 0, 2, 2]
    by = {r.n_tokens: r for r in out}
    assert by[2].token_ids == pair[1].encode("Some text", add_special_tokens=False).ids
    assert by[2].decoded == "some</w> text</w>" and by[0].decoded == ""
    assert bpe.encode_documents(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0
