import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from moorage.llm import common, token_files
from moorage.llm.queries import op4_token_files
from moorage.llm.token_files import ChunkEncoder, decode_segment, encode_segment, read_tokens, write_tokens
from tests.llm.conftest import SMALL

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ENCODER = ChunkEncoder(FILE)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def expected(texts):
    start, rows = 0, []
    for key, text in texts:
        ids = [*ids_of(text or ""), 0]
        rows.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize(
    "ids",
    [[], [5], [0] * 300, list(range(1000)), [0, 2**32 - 1] * 200, [7] * 255 + [50000] * 2, [3] * 256, [1, 2**31] * 128],
)
def test_blocks_round_trip(ids):
    data = np.frombuffer(encode_segment([1, None], [len(ids), 0], np.array(ids, np.uint32)), np.uint8)
    keys, counts, stream = decode_segment(data)
    assert (keys, counts.tolist(), stream.tolist()) == ([1, None], [len(ids), 0], ids)


def test_random_blocks_and_block_starts():
    rng = random.Random(3)
    ids = np.array([rng.choice([rng.randrange(50), rng.randrange(1 << 16), rng.randrange(1 << 32)]) for _ in range(5000)], np.uint32)
    data = np.frombuffer(encode_segment([1], [5000], ids), np.uint8)
    assert decode_segment(data)[2].tolist() == ids.tolist()
    starts = data[-8 * 20 :].copy().view("<u8").astype(np.int64)
    assert token_files.decode_blocks(data, starts[7:8]).tolist() == ids[7 * 256 : 8 * 256].tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab  \n\t.'s1"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_chunks_give_what_the_library_gives(text):
    for t in (text, text + "<|endoftext|> x " + text):
        assert np.frombuffer(ENCODER.encode([t])[0], "<u4").tolist() == ids_of(t)


@pytest.mark.parametrize("count", [1, 7, 8, 255, 256])
def test_values_of_every_width(count):
    rng = np.random.default_rng(5)
    for width in range(1, 33):
        values = rng.integers(0, 1 << width, (5, count), np.uint64).astype(np.uint32)
        assert token_files.unpack(token_files.pack(values, width), width, count).tolist() == values.tolist()


def test_chunks_of_a_batch_are_looked_up_once():
    """What odd and plain texts share comes out as if each had been encoded by itself."""
    encoder = ChunkEncoder(FILE)
    looked = []
    known = encoder._known
    encoder._known = lambda keys: looked.append(keys) or known(keys)
    texts = ["a cat, a cat", "", " cat", "cat", "a  cat", "cat ", "cat\n a", "x<|endoftext|> cat", "cat. cat"]
    rows = encoder.encode(texts * 3)
    assert len(looked[0]) < 5 + 3 * len(texts)
    assert [np.frombuffer(r, "<u4").tolist() for r in rows] == [ids_of(t) for t in texts] * 3


def test_new_chunks_of_a_batch_are_cut_together(monkeypatch):
    """Cutting takes a call for many chunks, and words that differ in their marks alone reach the model once."""
    cut, cuts, tokenized = token_files.CUT, [], []
    monkeypatch.setattr(token_files, "CUT", SimpleNamespace(findall=lambda text: cuts.append(text) or cut.findall(text)))
    encoder = ChunkEncoder(FILE)
    model = encoder.model
    encoder.model = SimpleNamespace(tokenize=lambda part: tokenized.append(part) or model.tokenize(part))
    texts = [f"wo{'xyz'[i % 3]}rd{mark} wo{'xyz'[i % 3]}rd{mark}\nend" for i, mark in enumerate([".", ",", ";", "!?", "%%", "'s"] * 5)]
    assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(texts)] == [ids_of(t) for t in texts]
    assert len(cuts) == 1 and len(tokenized) == len(set(tokenized)) < 20


MIXED = ["\xff \xffa, \u0100b\x00", "\u201cquoted\u201d it's don't", "\u4f60\u597d, \u4e16\u754c a\u0301", "x\u00b2 \u00bd\x1c", "a\n\n b \n", "", " ", "\n", "\x00\x00 \xad"]


@pytest.mark.parametrize("bounds", [{"AT_ONCE": 1}, {"AT_ONCE": 3}, {"CACHED_PARTS": 0}, {"CACHED_BYTES": 10}, {}])
def test_scripts_side_by_side_in_any_slices(monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(token_files, name, value)
    encoder = ChunkEncoder(FILE)
    texts = [*MIXED, " ".join(MIXED), "".join(MIXED), "<|endoftext|>".join(MIXED), *(f"{a} {b}" for a in MIXED for b in MIXED)]
    for batch in (texts, texts[::-1], texts[5:6], []):
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(batch)] == [ids_of(t) for t in batch]


def test_a_worker_forgets_parts_beyond_its_bounds(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_BYTES", 1000)
    encoder = ChunkEncoder(FILE)
    for i in range(50):
        encoder.encode(["w" * (90 + i)])
    assert encoder.size < 1200 and len(encoder.parts) < 15


def test_workers_hold_no_encoder_when_files_are_read():
    common.held_model(ChunkEncoder, FILE)
    assert list(token_files._parsed(iter([]))) == [] and not common._held


def test_query_equals_the_library(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 60_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = op4_token_files(spark, SMALL).collect()
    assert sorted(tuple(r) for r in rows) == expected(sorted((r.doc_id, r.text) for r in docs))


def test_nulls_repeats_extra_columns(spark):
    rows = [(2, "a  b", "x"), (None, "c", "x"), (1, None, None), (2, "a  b", "y"), (3, "", "z"), (-4, "w" * 20000, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = read_tokens(spark, write_tokens(docs, FILE)).orderBy("file", "place").collect()
    assert [r.doc_id for r in got] == [None, -4, 1, 2, 2, 3]
    texts = ["c", "w" * 20000, "", "a  b", "a  b", ""]
    assert [r.ids for r in got] == [[*ids_of(t), 0] for t in texts]
