from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from peerbench.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def known():
    return pieces.PrefixTable(pieces.read_model(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁\n\t\x00aabelst,.é中😀"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_the_library(text):
    found = pieces.prefix_table(pieces.read_model(PATH)).encode(text).tolist()
    assert found == LIBRARY.encode(text)


def test_texts_made_of_pieces_equal_the_library(known):
    rng = random.Random(3)
    parts = [LIBRARY.id_to_piece(i) for i in range(259, 32000, 3)] + ["<0x0A>", "<s>", "</s>", "<unk>", "  ", "   "]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        assert known.encode(text).tolist() == LIBRARY.encode(text)


@pytest.mark.parametrize("text", ["a" * 70_000, " " * 5_001, "ab" * 20_000 + "\n" * 3, "▁" * 33, "lower lower" * 2_000, "中" * 999 + "é"])
def test_long_runs(known, text):
    assert known.encode(text).tolist() == LIBRARY.encode(text)


def test_every_prefix_has_the_last_token_of_its_own_encoding(known):
    text = "▁the▁internationalisation▁of▁ﬁsh▁▁▁aaaaaaa"
    last = known.last_tokens(text)
    for end in range(1, len(text) + 1):
        own = known.ids(text[:end])
        assert own[-1] == (last[end - 1] if last[end - 1] < known.size else known.byte_ids[text[end - 1].encode()[-1]])


def test_bounds_on_what_is_remembered_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 3)
    small = pieces.PrefixTable(pieces.read_model(PATH))
    for text in ("one two three four five one two", "internationalisation of " * 5):
        assert small.encode(text).tolist() == LIBRARY.encode(text)
    assert len(small) <= 3 and len(small.pairs) <= 3


ROWS = [(1, "Hello  world", "x", 1), (2, None, None, 2), (3, "", "y", 3), (1, "Hello  world", "x", 1), (None, " \n", "é", 4), (4, "long text " * 30_000, "z", 5)]


def test_rows_with_nulls_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string, decoded int")
    model = pieces.read_model(PATH)
    got = pieces.encode(docs, model, docs.columns, decoded=True).collect()
    want = sorted(((r, LIBRARY.encode(r[1] or ""), LIBRARY.decode(LIBRARY.encode(r[1] or ""))) for r in ROWS), key=repr)
    assert sorted(((tuple(g["doc"]), g["ids"], g["decoded"]) for g in got), key=repr) == want
    back = pieces.decode(pieces.encode(docs, model).select("doc.doc_id", "ids"), model).collect()
    assert sorted((g["text"] for g in back)) == sorted(r[1] or "" for r in ROWS)
    empty = pieces.encode(docs.limit(0), model, decoded=True)
    assert empty.columns == ["doc", "ids", "decoded"] and empty.count() == 0


def test_more_rows_than_a_slice(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('row ', id, ' of many') as text").coalesce(1)
    got = pieces.encode(docs, pieces.read_model(PATH)).collect()
    assert {r["doc"]["doc_id"]: r["ids"] for r in got} == {i: LIBRARY.encode(f"row {i} of many") for i in range(3000)}


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = pieces.op12_pieces(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r["doc_id"]] or "")
        assert r.asDict() == {"doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids))), "decoded_sha256": sha(LIBRARY.decode(ids))}


def test_other_models_are_refused():
    with pytest.raises((ValueError, RuntimeError, OSError)):
        pieces.PrefixTable(b"no model")
