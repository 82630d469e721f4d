"""Licence scan by a generalised suffix automaton of licence words.

The automaton holds every run of words of all licence texts. A text is streamed through it word by word, which keeps
the longest run ending at each word that occurs in some licence (the matching statistics). Two things are read off:

* phrases, which end wherever the run held ends in one; all places count;
* matches of at least ``MIN_WORDS`` words, chained per template, in the order of the template and with gaps of at
  most ``MAX_GAP`` words, into spans. A span that covers ``MIN_COVERAGE`` of a template's words is a finding.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A null text has no words. Texts
are streamed in pieces that end between words, so a very long one takes little memory. Repeated rows each get their
result; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moorage.llm.common import pieces
from moorage.llm.licence_texts import BASE_PHRASES, PHRASES, TEMPLATES

MIN_WORDS = 5
MAX_GAP = 12
MIN_COVERAGE = 0.5

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

FOUND = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
SPANS = "spans array<struct<label: string, first: bigint, last: bigint, covered: bigint, coverage: double>>"


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class SuffixAutomaton:
    """Of several sequences of words; states know where their runs end."""

    def __init__(self, sequences: list[list[bytes]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, place after the last word)
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                self.ends[last].append((number, place + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]].extend(self.ends[state])

    def _new(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _fork(self, state: int, word: int, target: int) -> int:
        """A state of its own for the runs that are one longer than those of ``state``."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(dict(self.next[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._fork(last, word, known)
        new = self._new({}, 0, self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._fork(state, word, self.next[state][word])
        return new


@dataclass
class Chain:
    """A span that is being put together."""

    first: int
    last: int  # last word of the text
    place: int  # place after the last word of the template
    covered: int


@dataclass
class Findings:
    n_words: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)  # (phrase, first word)
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)  # (sequence, first, last, covered)


class LicenceScanner:
    def __init__(self, base: Mapping[str, str], phrases: Mapping[str, str], templates: Mapping[str, str]) -> None:
        texts = [*base, *phrases, *templates.values()]
        self.sequences = [words_of(t.encode()) for t in texts]
        self.labels = [*base.values(), *phrases.values(), *templates]
        self.base, self.phrases = len(base), len(base) + len(phrases)
        self.automaton = SuffixAutomaton(self.sequences)
        self.closing = self._closing()

    def _closing(self) -> dict[int, list[tuple[int, int]]]:
        """Phrases that end with the runs of a state, with their lengths: its own and those of the shorter runs."""
        automaton = self.automaton
        whole: dict[int, list[tuple[int, int]]] = {}
        for number in range(self.phrases):
            state = 0
            for word in self.sequences[number]:
                state = automaton.next[state][automaton.vocabulary[word]]
            whole.setdefault(state, []).append((number, len(self.sequences[number])))
        closing: dict[int, list[tuple[int, int]]] = {}
        for state in sorted(range(1, len(automaton.next)), key=lambda s: automaton.length[s]):
            found = [*closing.get(automaton.link[state], []), *whole.get(state, [])]
            if found:
                closing[state] = found
        return closing

    def scan(self, text: bytes) -> Findings:
        automaton, closing = self.automaton, self.closing
        following, link, length = automaton.next, automaton.link, automaton.length
        code = automaton.vocabulary.get
        found = Findings()
        chains: dict[int, Chain] = {}
        state = held = place = 0
        for piece in pieces(text, BREAK):
            for word in map(code, words_of(piece)):
                if word is None:
                    if held >= MIN_WORDS:
                        self._match(found, chains, state, held, place)
                    state = held = 0
                else:
                    if held >= MIN_WORDS and word not in following[state]:
                        self._match(found, chains, state, held, place)
                    while state and word not in following[state]:
                        state = link[state]
                        held = length[state]
                    state = following[state].get(word, 0)
                    held = held + 1 if state else 0
                    if state in closing:
                        found.places.extend((p, place + 1 - size) for p, size in closing[state] if size <= held)
                place += 1
        if held >= MIN_WORDS:
            self._match(found, chains, state, held, place)
        for number, chain in chains.items():
            self._close(found, number, chain)
        found.n_words = place
        found.places.sort()
        return found

    def _match(self, found: Findings, chains: dict[int, Chain], state: int, held: int, end: int) -> None:
        """Adds a run of ``held`` words before word ``end`` of the text to the chains of the templates it occurs in."""
        places: dict[int, list[int]] = {}
        for number, place in self.automaton.ends[state]:
            if number >= self.phrases:
                places.setdefault(number, []).append(place)
        for number, options in places.items():
            chain = chains.get(number)
            if chain and end - held - chain.last - 1 <= MAX_GAP:
                fitting = [p for p in options if p > chain.place and p - held - chain.place <= MAX_GAP]
                if fitting:
                    place = min(fitting)
                    chain.covered += min(held, place - chain.place, end - 1 - chain.last)
                    chain.last, chain.place = end - 1, place
                    continue
            if chain:
                self._close(found, number, chain)
            chains[number] = Chain(end - held, end - 1, min(options), held)

    def _close(self, found: Findings, number: int, chain: Chain) -> None:
        if chain.covered >= MIN_COVERAGE * len(self.sequences[number]):
            found.spans.append((number, chain.first, chain.last, chain.covered))

    def row(self, text: bytes | None) -> tuple:
        found = self.scan(text or b"")
        base = [(p, at) for p, at in found.places if p < self.base]
        labels, best, spans = set(), 0.0, []
        for phrase, at in found.places:
            size = len(self.sequences[phrase])
            labels.add(self.labels[phrase])
            spans.append((self.labels[phrase], at, at + size - 1, size, 1.0))
            best = 1.0
        for number, first, last, covered in found.spans:
            coverage = min(1.0, covered / len(self.sequences[number]))
            labels.add(self.labels[number])
            spans.append((self.labels[number], first, last, covered, coverage))
            best = max(best, coverage)
        starts = [at for _, at in base]
        named = ",".join(sorted({self.labels[p] for p, _ in base}))
        figures = (found.n_words, len(base), min(starts, default=None), max(starts, default=None))
        return (*figures, named, ",".join(sorted(labels)), best, sorted(spans, key=lambda s: (s[1], s[2], s[0])))


@lru_cache(maxsize=4)
def scanner(base: tuple, phrases: tuple, templates: tuple) -> LicenceScanner:
    return LicenceScanner(dict(base), dict(phrases), dict(templates))


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    base: Mapping[str, str] = BASE_PHRASES,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """Columns ``keep`` of each row, the figures of ``FOUND``, and the spans found, phrases among them."""
    rows = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").cast("binary").alias("text"))
    kept = "".join(f"kept_{i} {rows.schema[f'kept_{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    names = [c.split()[0] for c in FOUND.split(", ")] + ["spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    fields = {"label": pa.string(), "first": pa.int64(), "last": pa.int64(), "covered": pa.int64(), "coverage": pa.float64()}
    kinds.append(pa.list_(pa.struct(fields)))
    settings = tuple(tuple(m.items()) for m in (base, phrases, templates))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan_row = scanner(*settings).row
        for batch in batches:
            found = [scan_row(t.as_py()) for t in batch.column("text")]
            for row in found:
                row[-1][:] = [dict(zip(fields, span, strict=True)) for span in row[-1]]
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *columns], names=[*rest.schema.names, *names])

    return rows.mapInArrow(scan, f"{kept}{FOUND}, {SPANS}").withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})
