import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from moorage.llm.pieces import PieceCodec, encode_documents
from moorage.llm.queries import op8_sentencepiece
from tests.llm.conftest import SMALL

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = PieceCodec(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)

SAMPLES = [
    "",
    " ",
    "  a  b ",
    "\n",
    "a\x00b",
    "▁x ▁▁ y",
    "e\u0301 \u3000x \U0001f600\U0001f469\u200d\U0001f680",
    "<s> </s> <unk> <0x41>",
    "thhaoner, ouèleé éan\tla\r\nDesouaioué.$$$ ",
    " " * 40 + "x" + " " * 17,
    "a" * 3000,
    "https://example.com/aVeryLongPathWithoutAnySpaces?q=%20" * 40,
    "日本語のテキスト、漢字とかな",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_samples(text):
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeinorst h▁ "), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


def test_every_piece_and_random_joins():
    rng = random.Random(5)
    pieces = [LIBRARY.id_to_piece(i) for i in range(259, LIBRARY.vocab_size())]
    for _ in range(20000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 5))).replace("▁", " ")
        assert CODEC.encode(text) == LIBRARY.encode(text), text


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op8_sentencepiece(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, None, 7), (1, None, 7), (None, "a b", None), (2, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = encode_documents(docs, MODEL, keep=("doc_id", "text")).collect()
    assert sorted(((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in got), key=repr) == sorted(
        [(1, None, (), ""), (1, None, (), ""), (None, "a b", tuple(LIBRARY.encode("a b")), "a b"), (2, "", (), "")], key=repr
    )


def test_words_are_cut_where_no_piece_leads_across(monkeypatch):
    """Words with signs about them cost no search of their own."""
    codec = PieceCodec(MODEL)
    searched = []
    original = codec.backtracked
    monkeypatch.setattr(codec, "backtracked", lambda text: searched.append(text) or original(text))
    text = "thonre thonre, thonre. thonre; thonre.\nthonre! thonre12 thonre&&& thonre"
    assert codec.encode(text) == LIBRARY.encode(text)
    assert searched.count("▁thonre") == 1
    assert "".join(codec.parts("²..'s,é1")) == "²..'s,é1"
    rng = random.Random(11)
    for _ in range(20000):
        text = "".join(rng.choices([*".,!?'-²½\n\t$&é日x1_", "the", "don", " ", "ed.", "².", "...", "//", "://"], k=rng.randint(1, 9)))
        assert codec.encode(text) == LIBRARY.encode(text), text
