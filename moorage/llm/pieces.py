"""SentencePiece encoding and decoding of the merge type, exactly as its library does, by backtracking.

A text becomes pieces from left to right, without running the merges: at each place the longest piece that an
Aho-Corasick automaton finds there is tried, then shorter ones. A piece is accepted if it and the piece before stay
apart when their characters are merged anew; as merges are ranked, pieces that bear their neighbours are the result of
the whole. Places from which no piece leads on are noted in a bitfield and not tried again.

Merges never cross into a white space mark from the left, as no piece holds one after another character. So words are
encoded by themselves, and those met before come from a bounded cache. Nor do they cross between any two characters that
no piece holds side by side, such as a letter and the comma after it, so a new word is cut there. Only where several marks follow each other are
the characters merged outright: the pieces for runs of marks all have the same rank, which the pair check can't tell.

Null texts are taken as empty: no ids, empty decoded text. Characters that are no piece become the ids of their UTF-8
bytes. Texts of any length are encoded whole. The model file must have byte pieces and the identity normaliser.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moorage.llm.common import Memo, held_model, joined, lean, small_batches, split_words

MARK = "▁"
RUNNING = f"{MARK}|^ |  | $|^$"  # of texts that hold runs of marks, or marks of their own
RUNS = re.compile(f"{MARK}+[^{MARK}]*")
KINDS = re.compile(r"\w+|\W+")  # where words may be cut
# Bounds of the caches of a worker: some 200 bytes an entry, so below 60 MB each.
CACHED_WORDS = 300_000
CACHED_CHARS = 64  # longer words aren't cached
CACHED_PAIRS = 250_000
CACHED_SIGNS = 20_000  # stretches without letters inside words

# Kinds of pieces in a model file.
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6


class PieceCodec:
    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2 or model.normalizer_spec.precompiled_charsmap or not model.trainer_spec.byte_fallback:
            raise ValueError("the model must be of the merge type, with byte pieces and without normalisation")
        self.scores = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, USER_DEFINED, UNUSED)}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.surface = [p.piece.replace(MARK, " ").encode() for p in model.pieces]
        for byte, i in self.byte_ids.items():
            self.surface[i] = bytes([byte])
        self.surfaces = pa.array(self.surface, pa.large_binary())
        self.words: Memo = Memo(CACHED_WORDS, CACHED_CHARS)
        self.splits: dict[str, int] = {}
        self.signs: dict[str, bytes] = {}
        self.beside = {piece[i : i + 2] for piece in self.scores for i in range(len(piece) - 1)}
        self.automaton = self._automaton()

    def _automaton(self):
        """Of pieces of several characters that these merge to; others never come out."""
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for piece in self.scores:
            if len(piece) > 1 and self.merged(piece) == [piece]:
                automaton.add_word(piece, len(piece))
        automaton.make_automaton()
        return automaton

    def merged(self, text: str) -> list[str]:
        """The pieces by merging outright: again and again the best pair, of equals the leftmost."""
        symbols: list[str] = list(text)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                piece = symbols[left] + symbols[right]
                if piece in self.scores:
                    heapq.heappush(heap, (-self.scores[piece], left, piece))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, left, piece = heapq.heappop(heap)
            right = after[left]
            if not symbols[left] or right >= len(symbols) or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def split_at(self, text: str) -> int:
        """The length of the first of the two pieces that these characters merge to, 0 if they merge to more or fewer."""
        if len(self.splits) >= CACHED_PAIRS:
            self.splits.clear()
        pieces = self.merged(text)
        known = self.splits[text] = len(pieces[0]) if len(pieces) == 2 else 0
        return known

    def backtracked(self, text: str) -> list[str]:
        """The pieces of a text without runs of marks."""
        size, splits = len(text), self.splits
        lengths: list[list[int]] = [[1] for _ in text]
        for end, length in self.automaton.iter(text):
            lengths[end - length + 1].append(length)
        closed_places = bytearray(size + 1)
        starts: list[int] = []
        chosen: list[int] = []
        before, place, option = -1, 0, len(lengths[0]) - 1 if size else 0
        while place < size:
            options = lengths[place]
            while option >= 0:
                end = place + options[option]
                if not closed_places[end]:
                    if before < 0:
                        break
                    pair = text[before:end]
                    at = splits.get(pair)
                    if (self.split_at(pair) if at is None else at) == place - before:
                        break
                option -= 1
            if option >= 0:
                starts.append(place)
                chosen.append(option)
                before, place = place, end
                option = len(lengths[place]) - 1 if place < size else 0
            else:
                closed_places[place] = 1
                place, option = starts.pop(), chosen.pop() - 1
                before = starts[-1] if starts else -1
        return [text[start:end] for start, end in zip(starts, [*starts[1:], size])]

    def _ids(self, pieces: list[str]) -> list[int]:
        ids = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is None:
                ids.extend(self.byte_ids[b] for b in piece.encode())
            else:
                ids.append(known)
        return ids

    def _word(self, word: str) -> bytes:
        """Ids, 32 bits each. A word with marks in front stands for itself, else one is before it."""
        if word.startswith(MARK):
            return self._packed(self.merged(word))
        if not word.isalnum():
            parts = self.parts(word)
            if len(parts) > 1:
                return self._first(parts[0]) + b"".join(map(self._inner, parts[1:]))
        return self._first(word)

    def parts(self, word: str) -> list[str]:
        """The word cut between letters and signs that no piece holds side by side: merges never cross there."""
        parts: list[str] = []
        for part in KINDS.findall(word):
            if parts and parts[-1][-1] + part[0] in self.beside:
                parts[-1] += part
            else:
                parts.append(part)
        return parts

    def _first(self, word: str) -> bytes:
        """Ids of what a word begins with, which is often a word known by itself, or will be."""
        known = self.words.get(word) or self.words.old.get(word)
        if known is None:
            known = self._packed(self.backtracked(MARK + word))
            if len(word) <= CACHED_CHARS:
                self.words[word] = known
        return known

    def _inner(self, part: str) -> bytes:
        if part[0].isalpha():
            return self._packed(self.backtracked(part))
        known = self.signs.get(part)
        if known is None:
            known = self._packed(self.backtracked(part))
            if len(part) <= CACHED_CHARS:
                if len(self.signs) >= CACHED_SIGNS:
                    self.signs.clear()
                self.signs[part] = known
        return known

    def _packed(self, pieces: list[str]) -> bytes:
        ids = self._ids(pieces)
        return pack(f"<{len(ids)}i", *ids)

    def _bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.surface[i] for i in ids])

    def split(self, text: str) -> list[str]:
        words = text.replace(" ", MARK).split(MARK)
        if "" not in words:
            return words
        runs = RUNS.findall(MARK + text.replace(" ", MARK)) if text else []
        return [run if run.startswith(MARK, 1) else run[1:] for run in runs]

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Ids as 32-bit integers, for each text. Each different word is looked up once."""
        import pyarrow.compute as pc

        running = pc.match_substring_regex(texts, RUNNING).to_numpy(zero_copy_only=False)
        results: list[bytes] = [b""] * len(texts)
        plain = np.flatnonzero(~running)
        if len(plain):
            words, numbers, offsets = split_words(texts.take(pa.array(plain)))
            for i, ids in zip(plain, joined(self._known(words), numbers, offsets), strict=True):
                results[i] = ids
        for i in np.flatnonzero(running):
            results[i] = b"".join(self._known(self.split(texts[i].as_py())))
        return results

    def _known(self, words: list[str]) -> list[bytes]:
        self.words.fill(set(words), lambda new: map(self._word, new))
        known = list(map(self.words.get, words))
        if None in known:
            known = [self._word(w) if k is None else k for k, w in zip(known, words, strict=True)]
        return known

    def decode_batch(self, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
        """Texts of the ids between offsets. What pieces stand for lies one after another, so offsets are all it takes."""
        taken = self.surfaces.take(ids)
        places = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1, taken.offset * 8)
        data = np.frombuffer(taken.buffers()[2] or b"", np.uint8)
        ends = places[offsets].copy()
        starts = ends[:-1]
        # Every text but an empty one starts with a space of the encoder's own.
        spaced = (starts < ends[1:]) & (data[np.minimum(starts, max(0, len(data) - 1))] == 32) if len(data) else np.zeros(len(starts), bool)
        kept = np.ones(len(data), bool)
        kept[starts[spaced]] = False
        lengths = np.diff(ends) - spaced
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        body = data[places[offsets[0]] : places[offsets[-1]]][kept[places[offsets[0]] : places[offsets[-1]]]]
        return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch(pa.array([text]))[0], "<i4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        text = self._bytes(ids)
        return text.removeprefix(b" ").decode(errors="replace")


def encoded(batches: Iterable[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    """Adds ids and decoded to batches, in place of column ``text``."""
    model = held_model(PieceCodec, model_file)
    for batch in small_batches(batches, "text"):
        rows = model.encode_batch(batch.column("text").fill_null(""))
        offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in rows])]).astype("i4")
        flat = pa.array(np.frombuffer(b"".join(rows), "<i4"))
        ids, decoded = pa.ListArray.from_arrays(pa.array(offsets), flat), model.decode_batch(flat, offsets).cast(pa.string())
        kept = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*kept.columns, ids, decoded], names=[*kept.schema.names, "ids", "decoded"])


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row, with the ids of its text and the text decoded from them."""
    rows = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "".join(f"kept_{i} {kinds[f'kept_{i}']}, " for i in range(len(keep))) + "ids array<int>, decoded string"
    out = rows.mapInArrow(lean(lambda batches: encoded(batches, model_file)), schema)
    return out.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})
