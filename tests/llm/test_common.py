import random
import re
from pathlib import Path

import public_tokenizers
import pyarrow as pa

from moorage.llm import common
from moorage.llm.common import held_model
from moorage.llm.language import identify, learn
from moorage.llm.ngram_join import ngram_components
from moorage.llm.pieces import PieceCodec, encode_documents
from moorage.llm.token_files import ChunkEncoder


def test_one_model_at_a_time():
    files = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
    codec = held_model(PieceCodec, files[0])
    assert held_model(PieceCodec, files[0]) is codec
    held_model(ChunkEncoder, files[1])
    assert list(common._held) == [(ChunkEncoder, files[1])]
    common.forget_models()
    assert not common._held


def held_mb():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()).group(1)) / 1024


def test_freed_memory_goes_back_after_a_task():
    """An allocator would keep what lies below the last piece that is held."""
    before, last = [], []

    def task(batches):
        pieces = [bytes(2000) for _ in range(50_000)]
        last.append(bytes(2000))
        before.append(held_mb())
        yield from batches
        del pieces

    assert list(common.lean(task)(iter([1]))) == [1]
    assert held_mb() < before[0] - 80


def test_texts_of_one_word_count_and_lookup():
    """A word is looked up once in a batch, and the texts come out as if each had been encoded by itself."""
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["the cat the", "", " the", "cat  the", "the ", "the\u2581cat", "cat the cat"]
    looked = []
    known = codec._known
    codec._known = lambda words: looked.append(words) or known(words)
    rows = codec.encode_batch(pa.array(["", *texts, *texts]).slice(1))
    assert sorted(looked[0]) == ["cat", "the"]
    assert rows == [codec.encode_batch(pa.array([t]))[0] for t in texts + texts]


def test_workers_hold_no_model_in_stages_without_one(spark):
    """What the codec of one stage caches is not in the workers' memory in the next."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)), "en") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(32)

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._held)] * len(batch), pa.int64())], names=["n"])

    def most() -> int:
        return docs.select("doc_id").mapInArrow(held, "n bigint").agg({"n": "max"}).first()[0]

    for stage in (ngram_components, lambda d: identify(d, learn(d), keep=("doc_id",))):
        encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
        assert most() == 1
        for _ in range(3):  # idle workers take turns
            stage(docs).collect()
        assert most() == 0
