"""Byte-level BPE as a transducer that is determinised as texts need it, and streaming decoding.

Of all ways to cut a piece into tokens, its encoding is the one in which every two neighbours are an encoding of their own bytes.
So a transducer reads bytes: a state is the set of open readings, each the token before, a place in the trie of tokens,
and the tokens not yet told. A token that ends is told as soon as all open readings agree on it: readings start within the
length of the longest token, which bounds the lookahead. States and their transitions are made when a text first needs
them, and thrown away when there are ``STATES``; pieces that repeat come from a table of two halves of at most ``PIECES``. Whether two tokens may stand
side by side is found by undoing their merges.

Decoding goes token by token through an incremental UTF-8 machine, so that characters come out whole though their bytes may be in several
tokens. Bytes that are not UTF-8 become U+FFFD; text that was encoded comes back as it was.

Texts are read where they are, without a shuffle; ids leave a task in batches of bounded size. The vocabulary (``VOCABULARY`` tokens at most) is
broadcast.

Defined cases: NULL and empty texts have no tokens; strings that look like special tokens are plain text; repeated rows and ids stay row by row;
columns that are not named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES, PIECES, PAIRS, VOCABULARY = 1 << 17, 3 << 17, 1 << 18, 1 << 20
#: Tokens below a place of the trie up to which readings are told apart by them, longest piece that is kept, longest text cut at once, tokens of a batch that leaves a task, tokens decoded at a time.
FEW, KEPT, LONG, BATCH, CHUNK = 8, 32, 1 << 20, 1 << 19, 1 << 14


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a token in base64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """Parts of a piece after all merges in order of rank; with ``below`` only those of smaller rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None and (below is None or r < below)), default=None)
        if best is None:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, the two parts that the last merge of each joins (-1 for bytes), and tokens that no merges make: such a token stands for a whole piece only."""

    tokens: list[bytes]
    left: list[int]
    right: list[int]
    alone: frozenset[bytes]
    pattern: str

    @classmethod
    def of(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        if len(ranks) > VOCABULARY or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"a byte-level vocabulary has all bytes and at most {VOCABULARY} tokens")
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        parts = [merge(ranks, t, r) for r, t in enumerate(tokens)]
        left, right = ([ranks[p[at]] if len(p) == 2 else -1 for p in parts] for at in (0, 1))
        return cls(tokens, left, right, frozenset(t for t, p in zip(tokens, parts) if len(p) > 2), pattern)


class Transducer:
    """Bytes of one piece to token ids."""

    def __init__(self, vocabulary: Vocabulary, states: int = STATES):
        self.tokens, self.left, self.right, self.alone, self.most = vocabulary.tokens, vocabulary.left, vocabulary.right, vocabulary.alone, states
        self.ranks = {t: i for i, t in enumerate(vocabulary.tokens) if t}
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]  # token that ends at a place of the trie
        for token, rank in self.ranks.items():
            if token in self.alone:
                continue
            at = 0
            for b in token:
                at = self.child.setdefault(at << 8 | b, len(self.ends))
                if at == len(self.ends):
                    self.ends.append(-1)
            self.ends[at] = rank
        self.below = self._few()
        self.pairs: dict[int, bool] = {}
        self.forgets: dict[int, int] = {}
        self._clear()

    def _few(self) -> list[list[int] | None]:
        """By place of the trie, the tokens that end there or below; None where they are more than ``FEW``."""
        below: list[list[int] | None] = [[t] if t >= 0 else [] for t in self.ends]
        for step, at in sorted(self.child.items(), key=lambda x: -x[1]):  # places come after those above them
            up, own = below[step >> 8], below[at]
            below[step >> 8] = None if up is None or own is None or len(up) + len(own) > FEW else up + own
        return below

    def _before(self, before: int, node: int) -> int:
        """What a reading has to remember of the token before: itself, -1 if nothing, or -2 if no token can come of the reading."""
        few = self.below[node]
        if before < 0 or few is None:
            return before
        key = before << 32 | node
        known = self.forgets.get(key)
        if known is None:
            if len(self.forgets) >= PAIRS:
                self.forgets.clear()
            fit = sum(self.neighbours(before, t) for t in few)
            known = self.forgets[key] = -2 if not fit else -1 if fit == len(few) else before
        return known

    def _clear(self) -> None:
        self.number: dict[tuple, int] = {}
        self.readings: list[tuple] = []
        self.rest: list[tuple[int, ...]] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._state(((-1, 0, ()),))

    def _state(self, readings: tuple) -> int:
        at = self.number.get(readings)
        if at is None:
            at = self.number[readings] = len(self.readings)
            self.readings.append(readings)
            self.rest.append(readings[0][2])
        return at

    def neighbours(self, a: int, b: int) -> bool:
        """Whether ``b`` can follow ``a``: their bytes together are encoded as these two.

        Merges are undone on both sides of the border, the latest first. A merge across the border, had it been due before the one just
        undone, would have come first.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        tokens, ranks, due = self.tokens, self.ranks, len(self.tokens)
        while True:
            if ranks.get(tokens[a] + tokens[b], due) < due:
                return False
            if self.left[a] < 0 and self.left[b] < 0:
                return True
            if self.left[b] < 0 or a > b and self.left[a] >= 0:
                due, a = a, self.right[a]
            else:  # of equal ranks the one further left comes first, and that is the one across the border
                due, b = b + 1, self.left[b]

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinises one transition: the next state and the tokens that all its readings agree on."""
        open_, ended, child, ends = [], (), self.child, self.ends
        for before, node, told in self.readings[state]:
            node = child.get(node << 8 | byte)
            if node is None or (before := self._before(before, node)) == -2:
                continue
            open_.append((before, node, told))
            token = ends[node]
            if token >= 0 and (before < 0 or self.neighbours(before, token)):
                ended = told + (token,)
        # the reading that ends here stands first; there is one, as every beginning of a piece has an encoding
        n = len(ended)
        for _, _, told in open_:
            n = min(n, len(told))
            while told[:n] != ended[:n]:
                n -= 1
        shared = ended[:n]
        if n:
            open_ = [(before, node, told[n:]) for before, node, told in open_]
        readings = ((ended[-1], 0, ended[n:]), *open_)
        if len(self.readings) >= self.most and readings not in self.number:
            self._clear()
            return self._state(readings), shared
        move = self.moves[state << 8 | byte] = self._state(readings), shared
        return move

    def encode(self, piece: bytes) -> tuple[int, ...]:
        if piece in self.alone:
            return (self.ranks[piece],)
        state, out, moves = 0, [], self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
                moves = self.moves
            state, told = move
            if told:
                out += told
        return (*out, *self.rest[state])


class Table(dict):
    """Token ids by text, as bytes of 32-bit numbers; what was made is kept. When it is full it becomes the older half, from which texts come back as they are met."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= KEPT:
            if len(self) >= PIECES:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


#: White space beside a space.
_WIDE = re.compile(r" \s|\s ")


class Encoder:
    """Texts to token ids.

    Where every space stands alone, a text is looked up by its words: pieces have a space at their beginning only, so no piece goes on
    over it. The pattern cuts words that are new, and texts with wider spaces.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.pattern = regex.compile(vocabulary.pattern)
        self.transducer = Transducer(vocabulary)
        self.pieces, self.words = Table(self._piece), Table(self._word)

    def _piece(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return struct.pack(f"<{len(ids)}i", *ids)

    def _word(self, word: str) -> bytes:
        found = self.pattern.findall(" " + word)
        if len(found) == 1:
            return self._piece(found[0])
        # what stands after the space is a word of its own, if that was cut
        return b"".join([self.words[p[1:]] if p[0] == " " and len(p) > 1 else self.pieces[p] for p in found])

    def _cut(self, text: str) -> bytes:
        found = self.pattern.findall(text) if len(text) <= LONG else (m[0] for m in self.pattern.finditer(text))
        return b"".join(map(self.pieces.__getitem__, found))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<i4")
        if len(text) > LONG or _WIDE.search(text):
            return np.frombuffer(self._cut(text), "<i4")
        first, *words = text.split(" ")
        return np.frombuffer(self._cut(first) + b"".join(map(self.words.__getitem__, words)), "<i4")


#: UTF-8, fixed values: the state after a first byte, and by state the range of the next byte and the state after it.
_FIRST = [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)]
_NEXT = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}


def utf8_state(state: int, byte: int) -> int:
    """The state after a byte; 0 between characters, -1 if the byte cannot stand there."""
    ways = _FIRST if state == 0 else [_NEXT[state]]
    return next((after for low, high, after in ways if low <= byte <= high), -1)


class Decoder:
    """Token ids to text, in any portions: :meth:`feed` gives what is whole so far, :meth:`end` what is left."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.closed = np.array([self._run(0, t) == 0 for t in tokens])
        self.known: dict[tuple[int, int], int] = {}  # states after tokens, by the state before
        self.state, self.held = 0, b""

    @staticmethod
    def _run(state: int, token: bytes) -> int:
        for byte in token:
            state = utf8_state(state, byte)
            if state < 0:
                break
        return state

    def _after(self, state: int, token: int) -> int:
        after = self.known.get((state, token))
        if after is None:
            after = self.known[state, token] = self._run(state, self.tokens[token])
        return after

    def _whole(self, ids: np.ndarray) -> bool:
        """Whether the tokens are whole characters; only those that are not so by themselves are walked through."""
        at, state = -1, 0
        for odd in np.flatnonzero(~self.closed[ids]).tolist():
            if odd <= at:
                continue
            at, state = odd, self._after(0, int(ids[odd]))
            while state > 0 and at + 1 < len(ids):
                at += 1
                state = self._after(state, int(ids[at]))
            if state:
                return False
        return True

    def feed(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the characters that are whole after these tokens."""
        found = list(map(self.tokens.__getitem__, ids.tolist()))
        if self.state == 0 and self._whole(ids):
            return b"".join(found)
        out, at = [], 0
        while at < len(found):
            after = self._after(self.state, int(ids[at]))
            self.held += found[at]
            if after == 0:
                out.append(self.held)
                self.state, self.held = 0, b""
            elif after > 0:
                self.state = after
            else:
                out.append(self._mend())
            at += 1
        return b"".join(out)

    def _mend(self) -> bytes:
        """What is held, with U+FFFD for what cannot be; the unfinished end is held on."""
        out, good, state = [], b"", 0
        for byte in self.held:
            after = utf8_state(state, byte)
            if after < 0 and state:
                out.append("�".encode())
                good, after = b"", utf8_state(0, byte)
            if after < 0:
                out.append("�".encode())
                good, state = b"", 0
                continue
            good, state = good + bytes([byte]), after
            if state == 0:
                out.append(good)
                good = b""
        self.held, self.state = good, state
        return b"".join(out)

    def end(self) -> bytes:
        left = "�".encode() if self.held else b""
        self.state, self.held = 0, b""
        return left


def _chunks(decoder: Decoder, ids: np.ndarray) -> Iterator[bytes]:
    for start in range(0, len(ids), CHUNK):
        yield decoder.feed(ids[start : start + CHUNK])
    yield decoder.end()


#: Encoders of this process by the digest of their vocabulary: tasks that follow one another go on with the same states.
_HERE: dict[str, Encoder] = {}


def _encoder(name: str, vocabulary: Vocabulary) -> Encoder:
    if name not in _HERE:
        _HERE.clear()
        _HERE[name] = Encoder(vocabulary)
    return _HERE[name]


def _named(vocabulary: Vocabulary) -> str:
    return hashlib.sha256(repr((vocabulary.pattern, vocabulary.tokens)).encode()).hexdigest()


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)`` per row."""
    shared, name = docs.sparkSession.sparkContext.broadcast(vocabulary), _named(vocabulary)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, shared.value)
        for batch in batches:
            docs, texts, start, ids, ends = batch.column("doc_id"), batch.column("text"), 0, [], [0]

            def out(stop: int) -> pa.RecordBatch:
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                return pa.RecordBatch.from_arrays([docs.slice(start, stop - start), lists], names=["doc_id", "ids"])

            for i in range(batch.num_rows):
                ids.append(encoder.encode(texts[i].as_py()))
                ends.append(ends[-1] + len(ids[-1]))
                if ends[-1] >= BATCH:
                    yield out(i + 1)
                    start, ids, ends = i + 1, [], [0]
            if start < batch.num_rows:
                yield out(batch.num_rows)

    return slim.mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[a:b] for a, b in zip(ends, ends[1:]))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [b"".join(_chunks(decoder, ids)).decode() for ids in _lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digests(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of ``(doc_id, ids)``; decoded portions are hashed as they come."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, names = Decoder(shared.value), [str(i) for i in range(len(shared.value))]
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for ids in _lists(batch.column("ids")):
                told, text, join = hashlib.sha256(), hashlib.sha256(), ""
                for start in range(0, len(ids), CHUNK):
                    part = ids[start : start + CHUNK]
                    told.update((join + " ".join(map(names.__getitem__, part.tolist()))).encode())
                    join = " "
                for part in _chunks(decoder, ids):
                    text.update(part)
                counts.append(len(ids))
                of_ids.append(told.hexdigest())
                of_texts.append(text.hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
