import random
import re

from moorage.llm.licence_texts import BASE_PHRASES, PHRASES, TEMPLATES
from moorage.llm.licences import LicenceScanner, SuffixAutomaton, scan_licences, words_of
from moorage.llm.queries import op1_licences
from tests.llm.conftest import SMALL

SCANNER = LicenceScanner(BASE_PHRASES, PHRASES, TEMPLATES)
MIT = TEMPLATES["mit"]


def brute(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        sequences = [[bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        automaton = SuffixAutomaton(sequences)
        runs = {}
        for number, s in enumerate(sequences):
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    runs.setdefault(tuple(s[i:j]), set()).add((number, j))
        for run, ends in runs.items():
            state = 0
            for word in run:
                state = automaton.next[state][automaton.vocabulary[word]]
            assert set(automaton.ends[state]) == ends
            assert automaton.length[automaton.link[state]] < len(run) <= automaton.length[state]


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op1_licences(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_phrases_inside_other_phrases_and_templates():
    text = "x under the MIT license under the mit\nLicense. " + TEMPLATES["apache-2"] + " cc-by-nc cc by n"
    row = SCANNER.row(text.encode())
    assert row[:5] == brute(text)
    assert "apache-2" in row[5].split(",") and row[6] == 1.0


def test_spans_of_templates():
    words = MIT.split()
    edited = " ".join([*"aé b c".split(), *words[:20], "entirely", "new", *words[22:], "z"])
    *_, labels, score, spans = SCANNER.row(edited.encode())
    found = [s for s in spans if s[0] == "mit"]
    assert labels.split(",") == ["mit"] and len(found) == 1 and found[0][1] == 3 and 0.9 < score < 1
    assert SCANNER.row(" ".join(words[:12]).encode())[5:7] == ("", 0.0)
    twice = [s for s in SCANNER.row(f"{MIT} {MIT}".encode())[-1] if s[0] == "mit"]
    assert [s[1] for s in twice] == [0, len(words_of(MIT.encode()))]


def test_long_texts_are_streamed():
    text = ("lorem " * 300_000 + "under the mit license ") * 2
    assert SCANNER.row(text.encode())[:4] == (600_008, 2, 300_000, 600_004)
    assert SCANNER.row(b"x" * 3_000_000)[0] == 1


def test_nulls_repeats_extra_columns(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "CC BY-NC", "b"), (2, "", None)]
    got = scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string, labels string")).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 0, 0, None, None, "", "", 0.0)] * 2 + [(2, 0, 0, None, None, "", "", 0.0), (None, 3, 1, 0, 0, "cc-by-nc", "cc-by-nc", 1.0)], key=repr
    )
