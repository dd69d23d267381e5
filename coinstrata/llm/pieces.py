"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are marked (spaces become U+2581, one in front) and cut into words that no piece
crosses. The distinct words of a slice of texts are sorted, which is the depth-first order
of their trie, and each word keeps the forward states of the prefix that it shares with
the word before it: a state per trie node is computed once.

A forward state is the best way to cut the prefix that ends there:

* unigram models: the cut with the largest sum of piece scores, of equal ones the cut
  whose last piece is longest;
* BPE models: a cut is the result of merging exactly if each two neighbouring pieces are
  the result of merging their own letters. So the score of a cut is 0 if all neighbours
  agree and minus infinity otherwise, and every prefix has one cut that scores 0.

Both give what the public library gives for the model. Letters that are no piece become
their UTF-8 bytes, where the model has them, or the unknown piece.
"""

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from coinstrata.llm.common import slices

MARK = "▁"
#: Characters of text whose words are sorted together, and bytes of an Arrow batch that are
#: taken out of it at once.
SLICE_CHARS = 1_000_000
PART_BYTES = 8_000_000
#: Bytes of remembered words (so that frequent ones are cut once), by an estimate of what a
#: word of one letter in one piece takes, and of each letter and piece more.
REMEMBERED_BYTES = 48_000_000
WORD_BYTES, LETTER_BYTES, PIECE_BYTES = 230, 2, 8
#: Steps of the automaton and borders of pieces that are remembered, about 150 bytes each.
REMEMBERED = 200_000
# Fixed values of the library: piece types and the penalty of an unknown letter.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
UNKNOWN_SURFACE = " ⁇ "


@dataclass
class PieceModel:
    """The parts of a model file that encoding and decoding need, as plain values."""

    kind: int
    ids: dict[str, int]
    scores: dict[str, float]
    unknown: int
    byte_ids: list[int]
    surfaces: list[bytes]
    dummy_prefix: bool
    longest: int = 0
    lowest: float = 0.0
    #: For BPE, see ``_merging``.
    made: dict[str, int] = field(default_factory=dict)
    halves: dict[str, tuple[str, str]] = field(default_factory=dict)
    beginnings: set[str] = field(default_factory=set)

    def prepared(self) -> "PieceModel":
        self.longest = max(map(len, self.ids), default=1)
        self.lowest = min(self.scores.values(), default=0.0)
        if self.kind == BPE:
            self._merging()
        return self

    def words(self) -> re.Pattern:
        """Marked words. A line end is a word of its own where no piece holds one."""
        alone = "" if any("\n" in p for p in self.ids) else "\n"
        runs = f"{MARK}*[^{MARK}{alone}]+|{MARK}+"
        return re.compile(f"{runs}|{alone}+" if alone else runs)

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        """Read a model file on the driver. Its size is that of a vocabulary."""
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        return cls.of_proto(proto)

    @classmethod
    def of_proto(cls, proto) -> "PieceModel":
        spec, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only models that leave characters and blanks as they are")
        ids, scores, byte_ids, surfaces, unknown = {}, {}, [-1] * 256, [], 0
        for number, piece in enumerate(proto.pieces):
            surface = piece.piece.encode()
            if piece.type in (NORMAL, USER_DEFINED):
                ids[piece.piece], scores[piece.piece] = number, piece.score
                inner = piece.piece.lstrip(MARK)
                if MARK in inner or piece.type == USER_DEFINED:
                    raise ValueError(f"a piece that spans words: {piece.piece!r}")
            elif piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                byte_ids[value], surface = number, bytes([value])
            elif piece.type == UNKNOWN:
                unknown, surface = number, UNKNOWN_SURFACE.encode()
            else:
                surface = b""
            surfaces.append(surface)
        if -1 in byte_ids:
            byte_ids = []
        prefix = spec.add_dummy_prefix
        return cls(kind, ids, scores, unknown, byte_ids, surfaces, prefix).prepared()

    def _merging(self) -> None:
        """What BPE needs: when a piece is made (the rank of its score), of which two it is
        made, and all beginnings of pieces. Pieces that merging never makes are left out."""
        order = {s: i for i, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.made = {p: order[s] for p, s in self.scores.items() if len(p) > 1}
        self.halves = {p: h for p in self.made if (h := self._merged(p)) is not None}
        self.beginnings = {p[:n] for p in self.halves for n in range(1, len(p) + 1)}

    def _merged(self, piece: str) -> tuple[str, str] | None:
        """The two parts that make ``piece`` when its letters are merged: of all pairs that
        make a piece the one with the best score first, of equal ones the leftmost."""
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.made.get(a + b) for a, b in zip(parts, parts[1:])]
            if not any(r is not None for r in ranks):
                return None
            at = min((r, k) for k, r in enumerate(ranks) if r is not None)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def agreeing(self, left: str, right: str) -> bool:
        """Whether two pieces side by side are what merging their letters gives.

        Goes back in time: of the two pieces at the border the one that was made later is
        opened, and the border pair must not have been a piece made before that. Of equal
        ranks the left one is made first.
        """
        made, until = self.made, float("inf")
        if not left:
            return True
        while True:
            rank = made.get(left + right)
            if rank is not None and rank < until:
                return False
            a, b = made.get(left, -1), made.get(right, -1)
            if a > b:
                until, left = a, self.halves[left][1]
            elif b >= 0:
                until, right = b + 1, self.halves[right][0]
            else:
                return True

    def plain(self) -> dict:
        """All fields, as a broadcast value to make the model from again."""
        return dict(vars(self))


class Encoder:
    """Cuts marked words, each distinct one of a slice once, in sorted order."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.words = model.words()
        self.cut = re.compile(f"(?<=[^{MARK}]){MARK}")
        self.known: dict[str, tuple] = {}
        self.known_bytes = 0
        # For BPE: pieces as (text, number, length, which pieces may stand to the left), and
        # an automaton over the beginnings of pieces, made as it is met. A node has steps by
        # letter, the pieces that end there, the longest first, and its own letters. A step
        # has the next node and the letter as a piece of its own.
        self.pieces = {p: (p, model.ids[p], len(p), {}) for p in model.halves}
        self.nodes: dict[str, tuple] = {}
        #: The nodes of the letters of the word before, as ``last`` has its states.
        self.path = [self._node("")]
        self.steps = self.pairs = 0

    def encode(self, texts: Iterable[str | None]) -> Iterator[array]:
        """The piece numbers of each text; null and empty texts have none."""
        for run in slices(list(texts), SLICE_CHARS, lambda t: len(t) if t else 0):
            if len(run) == 1:  # maybe a very long text: one segment at a time
                out = array("i")
                for segment in self._segments(run[0]):
                    out.extend(self._encoded([self.words.findall(segment)])[0])
                yield out
            else:
                yield from self._encoded(
                    [[w for s in self._segments(t) for w in self.words.findall(s)] for t in run]
                )

    def _encoded(self, texts: list[list[str]]) -> list[array]:
        """Piece numbers of texts given as words: each new word is cut once."""
        known = self.known
        present = {w for words in texts for w in words}
        new = sorted(present.difference(known))
        cuts = list(self._in_trie(new))
        known.update(zip(new, cuts))
        out = [array("i", chain.from_iterable(map(known.__getitem__, words))) for words in texts]
        self.known_bytes += WORD_BYTES * len(new) + LETTER_BYTES * sum(map(len, new))
        self.known_bytes += PIECE_BYTES * sum(map(len, cuts))
        if self.known_bytes > REMEMBERED_BYTES:
            # Words that were met again are the frequent ones.
            again = present.difference(new)
            self.known = {w: known[w] for w in again}
            self.known_bytes = sum(
                WORD_BYTES + LETTER_BYTES * len(w) + PIECE_BYTES * len(c) for w, c in self.known.items()
            )
            if self.known_bytes > REMEMBERED_BYTES // 2:
                self.known, self.known_bytes = {}, 0
        return out

    def _segments(self, text: str | None) -> Iterator[str]:
        """The marked text in parts of bounded length that no piece crosses."""
        if not text:
            return
        marked = text.replace(" ", MARK)
        if self.model.dummy_prefix:
            marked = MARK + marked
        start = 0
        while len(marked) - start > SLICE_CHARS:
            found = self.cut.search(marked, start + SLICE_CHARS)
            if found is None:
                break
            yield marked[start : found.start()]
            start = found.start()
        yield marked[start:]

    def _in_trie(self, words: list[str]) -> Iterator[tuple]:
        """Cuts of sorted words. The states of the first i letters, ``last[i]``, hold for
        all words that share these letters."""
        first, extend = (
            (("", -1, 0), self._extend_bpe)
            if self.model.kind == BPE
            else (("", -1, 0, 0.0), self._extend_unigram)
        )
        last, before = [first], ""
        del self.path[1:]
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            extend(word, shared, last)
            yield self._numbers(word, last)
            before = word

    def _extend_unigram(self, word: str, done: int, last: list) -> None:
        """States (piece, number, length, score) of the letters after the first ``done``."""
        ids, scores = self.model.ids, self.model.scores
        unknown = self.model.lowest - UNKNOWN_PENALTY
        for end in range(done + 1, len(word) + 1):
            best = None
            for j in range(max(0, end - self.model.longest), end):
                piece = word[j:end]
                score = scores.get(piece)
                if score is None and j == end - 1:
                    score = unknown
                if score is not None:
                    score += last[j][3]
                    if best is None or score > best[3]:
                        best = (piece, ids.get(piece, -1), end - j, score)
            last.append(best)

    def _extend_bpe(self, word: str, done: int, last: list) -> None:
        """States (piece, number, length) of the letters after the first ``done``."""
        path = self.path
        del path[done + 1 :]
        node = path[done]
        for end in range(done + 1, len(word) + 1):
            letter = word[end - 1]
            node, alone = node[0].get(letter) or self._step(node, letter)
            for entry in node[1]:
                left = last[end - entry[2]][0]
                fit = entry[3].get(left)
                if fit or fit is None and self._agreeing(left, entry):
                    break
            else:
                entry = alone  # a single letter is what merging leaves here
            last.append(entry)
            path.append(node)

    def _node(self, letters: str) -> tuple[dict, list, str]:
        node = self.nodes.get(letters)
        if node is None:
            ends = [letters[k:] for k in range(len(letters))]
            node = ({}, [self.pieces[e] for e in ends if e in self.pieces], letters)
            self.nodes[letters] = node
        return node

    def _step(self, node: tuple, letter: str) -> tuple[tuple, tuple]:
        """To the longest end of the letters so far that begins a piece."""
        if self.steps >= REMEMBERED:
            self.steps = 0
            for held in self.nodes.values():
                held[0].clear()
        letters = node[2] + letter
        while letters and letters not in self.model.beginnings:
            letters = letters[1:]
        step = node[0][letter] = (
            self._node(letters), (letter, self.model.ids.get(letter, -1), 1)
        )
        self.steps += 1
        return step

    def _agreeing(self, left: str, entry: tuple) -> bool:
        self.pairs += 1
        if self.pairs > REMEMBERED:
            self.pairs = 0
            for held in self.pieces.values():
                held[3].clear()
        entry[3][left] = self.model.agreeing(left, entry[0])
        return entry[3][left]

    def _numbers(self, word: str, last: list) -> tuple:
        out, end = [], len(word)
        while end:
            state = last[end]
            number, length = state[1], state[2]
            if number >= 0:
                out.append(number)
            elif self.model.byte_ids:
                out.extend(self.model.byte_ids[b] for b in reversed(word[end - 1].encode()))
            elif not out or out[-1] != self.model.unknown:
                out.append(self.model.unknown)  # a run of unknown letters is one piece
            end -= length
        out.reverse()
        return tuple(out)


def decoded(model: PieceModel, numbers) -> str:
    """The text of piece numbers. Bytes that are no UTF-8 become U+FFFD."""
    text = b"".join([model.surfaces[n] for n in numbers]).decode("utf-8", "replace")
    text = text.replace(MARK, " ")
    return text[1:] if model.dummy_prefix and text.startswith(" ") else text


def parts(batch: pa.Array) -> Iterator[pa.Array]:
    """An array in parts of about PART_BYTES, so that the values of one part at a time are
    Python's. A longer row is a part by itself."""
    if not len(batch):
        yield batch
    at_once = max(1, int(len(batch) * PART_BYTES / max(1, batch.nbytes)))
    for start in range(0, len(batch), at_once):
        yield batch.slice(start, at_once)


def encode(text: Column, model: PieceModel, spark: SparkSession) -> Column:
    """array<int> of each text's piece numbers. Null and empty texts have no pieces; texts
    are encoded whole, however long. U+2581 in a text is the same as a space."""
    shared = spark.sparkContext.broadcast(model.plain())

    @F.arrow_udf("array<int>")
    def encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(PieceModel(**shared.value))
        for batch in texts:
            made = [_lists(list(encoder.encode(part.to_pylist()))) for part in parts(batch)]
            yield pa.concat_arrays(made)

    return encoded(text)


def encode_and_decode(text: Column, model: PieceModel, spark: SparkSession) -> Column:
    """struct<pieces: array<int>, decoded: string>: what ``encode`` gives for a text, and
    what ``decode`` gives for that. One worker does both, so that there is one model."""
    shared = spark.sparkContext.broadcast(model.plain())

    @F.arrow_udf("struct<pieces: array<int>, decoded: string>")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = PieceModel(**shared.value)
        encoder = Encoder(model)
        for batch in texts:
            pieces, texts_again = [], []
            for part in parts(batch):
                made = list(encoder.encode(part.to_pylist()))
                texts_again.append(pa.array([decoded(model, m) for m in made], pa.string()))
                pieces.append(_lists(made))
            yield pa.StructArray.from_arrays(
                [pa.concat_arrays(pieces), pa.concat_arrays(texts_again)], ["pieces", "decoded"]
            )

    return both(text)


def _lists(rows: list[array]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate([np.frombuffer(r, dtype=np.int32) for r in rows if len(r)] or [[]])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def decode(numbers: Column, model: PieceModel, spark: SparkSession) -> Column:
    """The text of an array of piece numbers; null becomes an empty text. The tasks get the
    pieces' surfaces only."""
    shared = spark.sparkContext.broadcast((model.surfaces, model.dummy_prefix))

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        surfaces, dummy_prefix = shared.value
        model = PieceModel(0, {}, {}, 0, [], surfaces, dummy_prefix)
        for batch in batches:
            values = batch.values.to_numpy(zero_copy_only=False)
            ends = batch.offsets.to_pylist()
            rows = (decoded(model, values[a:b].tolist()) for a, b in zip(ends, ends[1:]))
            yield pa.array(rows, pa.string())

    return texts(numbers)


def default_model() -> str:
    """Path of the public 32,000-piece model; any other path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
