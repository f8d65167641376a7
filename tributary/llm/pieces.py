"""SentencePiece encoding and decoding with a given model's pieces and scores.

One Aho-Corasick automaton over the pieces reads the UTF-8 bytes of a text once. At every position
the output links name all pieces that end there, from the longest to the shortest, and the best one
is kept as the last piece of the text so far; walking back from the end gives the segmentation.

What is best depends on the kind of model. For unigram models it is the highest sum of scores
(Viterbi). A BPE model joins neighbours in the order of their scores instead, and a sum of scores
gives other pieces than the model means; there, the best last piece is the one that these joins leave
next to the best piece before it, which is unique (``Model.stands``).

Characters that no piece covers become byte pieces. A blank stands for the model's blank mark, so that
a mark in the text itself is kept apart, and decoding gives every text back byte for byte. Texts are
cut where no piece of the model could reach across, which changes no result; equal cuts are solved
once, and a bounded number of them is remembered.

Defined results: a null or empty text has no tokens, and no tokens decode to an empty text; between
equal sums the longest last piece wins; control pieces are never produced and decode to nothing;
columns beyond those named are ignored.
"""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_fields, described

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Remembered pairs of pieces in each Python worker.
_MEMORY = 200_000


def _kind_of(proto: bytes) -> int:
    """Field ``model_type`` of the trainer settings in a serialized model; unigram if unset."""

    def fields(data: bytes):
        at = 0

        def number() -> int:
            nonlocal at
            value, shift = 0, 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(tag & 7) or number()
                at += size
                yield tag >> 3, data[at - size : at]

    for field, settings in fields(proto):
        if field == 2:
            return next((value for name, value in fields(settings) if name == 3), UNIGRAM)
    return UNIGRAM


class Model:
    """Pieces of a model file; ``pieces`` maps bytes, blanks for marks, to (number, score)."""

    def __init__(self, path: str):
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = _kind_of(reader.serialized_model_proto())
        self.pieces: dict[bytes, tuple[int, float]] = {}
        self.byte_number = [-1] * 256
        self.form: list[bytes] = []
        for number in range(reader.get_piece_size()):
            piece = reader.id_to_piece(number)
            form = b""
            if reader.is_byte(number):
                self.byte_number[int(piece[3:-1], 16)] = number
                form = bytes([int(piece[3:-1], 16)])
            elif not (reader.is_control(number) or reader.is_unknown(number) or reader.is_unused(number)):
                form = piece.replace(MARK, " ").encode()
                self.pieces[form] = (number, reader.get_score(number))
            self.form.append(form)
        if min(self.byte_number) < 0:
            raise ValueError("the model has no byte pieces, so it cannot give every text back")
        #: Of each piece the two that were joined last to make it, by number; none for single characters.
        self.halves: dict[int, tuple[int, int]] = {}
        if self.kind == BPE:
            for form, (number, _) in self.pieces.items():
                parts = self._joined(form)
                if parts is not None and len(parts) == 2:
                    self.halves[number] = (self.pieces[parts[0]][0], self.pieces[parts[1]][0])

    def score(self, number: int) -> float:
        return self.pieces[self.form[number]][1]

    def _joined(self, form: bytes) -> list[bytes] | None:
        """The parts of a piece before its last join, or None if joins never lead to the piece."""
        parts = [letter.encode() for letter in form.decode()]
        while len(parts) > 2:
            options = [(self.pieces[a + b][1], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.pieces]
            if not options:
                return None
            at = -max(options)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts if all(part in self.pieces for part in parts) else None

    def stands(self, left: int, right: int) -> bool:
        """Whether joins by score leave the two pieces next to each other.

        Looks back in time: as long as the later made of the two is taken apart again, a join across
        the border must not have come before it was made. Of equal scores the leftmost join is first.
        """
        made = float("-inf")  # score of the join that ends the state looked at
        leftmost = True
        while True:
            across = self.pieces.get(self.form[left] + self.form[right])
            if across is not None and (across[1] > made or (across[1] == made and leftmost)):
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and self.score(left) < self.score(right)):
                made, leftmost, left = self.score(left), False, a[1]
            else:
                made, leftmost, right = self.score(right), True, b[0]


class Automaton:
    """Aho-Corasick automaton over bytes, and the single pass over its output links."""

    def __init__(self, model: Model):
        self.model = model
        children: list[dict[int, int]] = [{}]
        number = [-1]
        for form, (piece, _) in model.pieces.items():
            at = 0
            for byte in form:
                after = children[at].get(byte)
                if after is None:
                    after = children[at][byte] = len(children)
                    children.append({})
                    number.append(-1)
                at = after
            if model.kind != BPE or piece in model.halves or len(form.decode()) == 1:
                number[at] = piece
        size = len(children)
        go = np.zeros((size, 256), np.uint16 if size < 1 << 16 else np.int32)
        fail, first, link = [0] * size, [0] * size, [0] * size
        queue = deque([0])
        while queue:
            at = queue.popleft()
            row = go[at]
            row[:] = go[fail[at]]
            if at:
                link[at] = first[fail[at]]
                first[at] = at if number[at] >= 0 else link[at]
            for byte, after in children[at].items():
                fail[after] = int(row[byte]) if at else 0
                row[byte] = after
                queue.append(after)
        self.go = memoryview(go)
        #: At each state the numbers of the pieces that end there, from the longest to the shortest.
        ends: list[tuple[int, ...]] = [()] * size
        for at in range(size):
            chain, node = [], first[at]
            while node:
                chain.append(number[node])
                node = link[node]
            ends[at] = tuple(chain)
        self.ends = ends
        self.size = [len(form) for form in model.form]
        self.fallback = min(value for _, value in model.pieces.values()) - 10.0
        # Pairs of neighbouring bytes inside some piece; between any others a text may be cut.
        self.inside = np.zeros((256, 256), bool)
        for form in model.pieces:
            for pair in zip(form, form[1:]):
                self.inside[pair] = True
        # No cut inside a character.
        self.inside[:, 128:192] = True
        self.standing: dict[int, bool] = {}

    def solve(self, text: bytes) -> list[int]:
        """Token numbers of one stretch of text."""
        return self._by_joins(text) if self.model.kind == BPE else self._by_sums(text)

    def _by_joins(self, text: bytes) -> list[int]:
        go, ends, size, standing = self.go, self.ends, self.size, self.standing
        many = len(size)
        last = [-1] * (len(text) + 1)  # -1: nothing, or a byte piece, with which nothing is joined
        state = 0
        for at, byte in enumerate(text, 1):
            state = go[state, byte]
            for piece in ends[state]:
                before = last[at - size[piece]]
                if before < 0:
                    # A character without a piece, or the inside of one, parts what is around it.
                    fits = True
                else:
                    fits = standing.get(before * many + piece)
                    if fits is None:
                        fits = self.model.stands(before, piece)
                        if len(standing) < _MEMORY:
                            standing[before * many + piece] = fits
                if fits:
                    last[at] = piece
                    break
        return self._back(text, last)

    def _by_sums(self, text: bytes) -> list[int]:
        go, ends, size, pieces, form = self.go, self.ends, self.size, self.model.pieces, self.model.form
        best, last = [0.0], [-1]
        state = 0
        for at, byte in enumerate(text, 1):
            state = go[state, byte]
            top, by = best[at - 1] + self.fallback, -1
            for piece in ends[state]:
                value = best[at - size[piece]] + pieces[form[piece]][1]
                if value > top:
                    top, by = value, piece
            best.append(top)
            last.append(by)
        return self._back(text, last)

    def _back(self, text: bytes, last: list[int]) -> list[int]:
        tokens, at = [], len(text)
        while at:
            piece = last[at]
            if piece < 0:
                at -= 1
                tokens.append(self.model.byte_number[text[at]])
            else:
                at -= self.size[piece]
                tokens.append(piece)
        return tokens[::-1]


class Encoder:
    def __init__(self, model: Model, remembered: int = 100_000):
        self.automaton = Automaton(model)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = array("i")
        self.starts = array("q", [0])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts in a flat array of token numbers, and that array."""
        if len(self.known) > self.remembered:
            self._forget()
        raw = [b" " + text.encode("utf-8", "replace") if text else b"" for text in texts]
        ends = np.cumsum([len(text) for text in raw]) if raw else np.zeros(0, np.int64)
        whole = b"".join(raw)
        letters = np.frombuffer(whole, np.uint8)
        cuts = np.flatnonzero(~self.automaton.inside[letters[:-1], letters[1:]]) + 1
        cuts = np.unique(np.concatenate(([0], cuts, ends))) if len(whole) else np.zeros(1, np.int64)
        places = cuts.tolist()
        known, pool, starts, solve = self.known, self.pool, self.starts, self.automaton.solve
        index = []
        for start, end in zip(places, places[1:]):
            cut = whole[start:end]
            number = known.get(cut)
            if number is None:
                number = known[cut] = len(known)
                pool.extend(solve(cut))
                starts.append(len(pool))
            index.append(number)
        index = np.array(index, np.int64)
        # Copies: an array that numpy looks into could not grow.
        starts, pool = np.array(starts), np.array(pool, np.int32)
        counts = np.diff(starts)[index] if len(index) else np.zeros(0, np.int64)
        upto = np.concatenate(([0], np.cumsum(counts)))
        where = np.repeat(starts[index] - upto[:-1], counts) + np.arange(upto[-1]) if len(index) else np.zeros(0, np.int64)
        return np.concatenate(([0], upto[np.searchsorted(cuts, ends)])), pool[where]


_ENCODERS: dict[str, Encoder] = {}


def _encoder_of(key: str, shared) -> Encoder:
    """One automaton for each Python worker and model."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def _slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of rows with a bounded number of bytes, or a single row."""
    start, size = 0, 0
    for at, length in enumerate(texts.cast(pa.large_binary()).fill_null(b"")):
        size += len(length.as_buffer() or b"") if length.is_valid else 0
        if size >= most:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(
    documents: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", verify: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, tokens, *keep)`` with one list of token numbers per document.

    With ``verify`` there is also ``exact``: whether decoding the tokens gave the text back.
    """
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("_text"), *(F.col(name).alias(name) for name in keep))
    schema = pa.schema([*arrow_fields(rows, ("id",)), ("tokens", pa.list_(pa.int32())), *[("exact", pa.bool_())] * verify, *arrow_fields(rows, keep)])
    shared = documents.sparkSession.sparkContext.broadcast(model)
    key = f"{len(model.form)}-{hash(tuple(model.form))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, end in _slices(whole.column(1)):
                batch = whole.slice(start, end - start)
                texts = batch.column(1).to_pylist()
                offsets, tokens = _encoder_of(key, shared).encode(texts)
                made = []
                if verify:
                    form, numbers, ends = shared.value.form, tokens.tolist(), offsets.tolist()
                    back = [decode_tokens(form, numbers[a:b]) for a, b in zip(ends, ends[1:])]
                    made = [pa.array([own == (text or "") for own, text in zip(back, texts)])]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, *made, *batch.columns[2:]], schema=schema)

    result = ", ".join(filter(None, (described(rows, ("id",)), "tokens array<int>" + ", exact boolean" * verify, described(rows, keep))))
    return rows.mapInArrow(run, result)


def decode_tokens(form: list[bytes], tokens: list[int] | None) -> str:
    """Text of token numbers; the blank that encoding puts in front goes."""
    return b"".join([form[token] for token in tokens or ()])[1:].decode("utf-8", "replace")


def decode(encoded: DataFrame, model: Model, *, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of its tokens."""
    names = tuple(name for name in encoded.columns if name != into)
    rows = encoded.select(*names)
    schema = pa.schema([*arrow_fields(rows, names), (into, pa.string())])
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    at = names.index(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = shared.value.form
        for batch in batches:
            texts = [decode_tokens(form, row.values.tolist() if row.is_valid else None) for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=schema)

    return rows.mapInArrow(run, f"{described(rows, names)}, `{into}` string")
