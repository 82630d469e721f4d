from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from moorage.llm.mixing import mixture_report
from moorage.session import materialise
from tests.llm.conftest import SMALL
from tests.llm.test_ngram_join import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"


def test_stages_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "mixture", "pieces"]

    told = materialise(stages["language"](spark, docs, SMALL))
    assert told.columns == docs.columns
    assert told.count() >= 0.98 * docs.count()

    alone = materialise(stages["near_copies"](spark, told, SMALL))
    groups = brute([(r.doc_id, r.text) for r in told.collect()])
    assert alone.columns == docs.columns
    assert sorted(r.doc_id for r in alone.collect()) == sorted({c for _, _, c in groups})

    mixed = materialise(stages["mixture"](spark, alone, SMALL))
    assert mixed.columns == docs.columns
    expected = {r.doc_id: r.taken // r.size for r in mixture_report(alone).collect() if r.taken}
    assert Counter(r.doc_id for r in mixed.collect()) == expected

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = Counter((r.doc_id, len(library.encode(r.text))) for r in mixed.collect())
    result = corpus_pipeline.run(spark, SMALL)
    assert Counter((r.doc_id, r.n_tokens) for r in result.collect()) == counts


def test_odd_rows(spark, stored):
    text = " ".join(f"the{i}" for i in range(30))
    rows = [(i, f"the quick word{i} and another{i * 7} word of text number{i}", "en", "s", 1, 0.5) for i in range(40)]
    rows += [(50, text, "en", "s", 1, None), (51, text, "en", None, 1, None), (50, text, "en", "s", 1, None)]
    rows += [(52, None, "en", "s", 1, None), (53, "12 ..", "en", "s", 1, None), (None, text, None, None, None, None), (54, "", "en", "s", 0, 0.0)]
    rows += [(55, text + " z", "en", "s", 1, None), (55, "some quite other text of seven words", "en", "s", 1, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    told = materialise(stages["language"](spark, docs, ""))
    ids = [r.doc_id for r in told.collect()]
    assert told.columns == docs.columns and len(ids) == len(rows) - 3 and not {52, 53, 54} & set(ids)
    alone = stages["near_copies"](spark, told, "")
    kept = Counter(r.doc_id for r in alone.collect())
    assert alone.columns == docs.columns
    assert kept == Counter([*range(40), 50, None, 55, 55])
    assert corpus_pipeline.run(spark, stored(documents=(rows, SCHEMA))).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_documents(spark, stored):
    assert corpus_pipeline.run(spark, stored(documents=([], SCHEMA))).count() == 0
