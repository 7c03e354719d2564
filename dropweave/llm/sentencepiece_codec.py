"""SentencePiece encoding and decoding by one pass over the trie of distinct marked words.

A text gets the model's dummy prefix, spaces become the mark U+2581, and it falls apart into marked words: a run of
marks with what follows up to the next mark.  No piece of a supported model crosses such a border, so words are encoded
on their own.  The distinct words of a chunk are sorted; going through them in order is a depth-first walk of
their trie, and the forward states of a prefix that two neighbours share are kept, not worked out again.

The forward state of a prefix is its best last piece.  A unigram model takes the piece with the largest sum of scores
(Viterbi).  A BPE model has merge ranks for scores, whose sum says nothing, so there the recursion takes the
piece that merging would leave beside the last piece of the shorter prefix: a row of pieces is what merging
leaves exactly when that holds for all neighbours.  Whether it holds is a property of two pieces and is remembered.

Characters without a piece become byte pieces (or the unknown piece if the model has none).  Decoding joins
pieces and bytes and takes off the dummy prefix; bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropweave.llm._common import text_chunks

MARK = "▁"
KEPT_WORDS = 150_000
SHORT = (2, 1)
DECODED_ROWS = 500
ROUND_BYTES = 2 * 1024 * 1024
KEPT_FITS = 300_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            length, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + length], at + length
        yield key >> 3, value


class Pieces:
    """The vocabulary of a model file.  Its size is the vocabulary's, so it may be sent to every task."""

    def __init__(self, model: bytes) -> None:
        names, scores, kinds, trainer, normalizer = [], [], [], {}, {}
        for field, value in _message(model):
            if field == 1:
                piece = dict(_message(value))
                names.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, 1))
            elif field == 2:
                trainer = dict(_message(value))
            elif field == 3:
                normalizer = dict(_message(value))
        self.is_bpe = trainer.get(3, 1) == 2
        self.dummy_prefix = bool(normalizer.get(3, 1))
        if normalizer.get(2) or normalizer.get(4, 1) or trainer.get(3, 1) not in (1, 2):
            raise ValueError("only unigram and BPE models that leave text as it is are supported")
        self.scores = scores
        if any(MARK in name.lstrip(MARK) for name, kind in zip(names, kinds) if kind in (1, 4)):
            raise ValueError("a piece crosses the border of words")
        # Inside this module the mark is the space it stands for.
        self.ids = {name.replace(MARK, " "): i for i, (name, kind) in enumerate(zip(names, kinds)) if kind in (1, 4)}
        self.unknown = kinds.index(2)
        byte_ids = [i for i, kind in enumerate(kinds) if kind == 6]
        self.bytes = byte_ids if len(byte_ids) == 256 else None
        self.surface = [name.replace(MARK, " ").encode() if kind in (1, 4) else b"" for name, kind in zip(names, kinds)]
        self.surface[self.unknown] = " ⁇ ".encode()
        for byte, i in enumerate(self.bytes or ()):
            self.surface[i] = bytes([byte])
        # Of BPE pieces: the two parts of the last merge, or None for what no merge makes.  A character is its own part.
        self.parts: dict[str, tuple[str, str] | None] = {}
        if self.is_bpe:
            for name in self.ids:
                self.parts[name] = last_merge(name, self)
        self.codec: Codec | None = None
        self.names = [name.replace(MARK, " ") for name in names]
        self.fits: dict[int, bool] = {}  # by the ids of two pieces
        lengths: dict[str, set[int]] = {}
        for name in self.ids:
            if len(name) > 2:
                lengths.setdefault(name[-3:], set(SHORT)).add(len(name))
        # Lengths that a last piece can have, by the last three characters.
        self.tails = {tail: tuple(sorted(found, reverse=True)) for tail, found in lengths.items()}

    @classmethod
    def load(cls, path: str) -> Pieces:
        with open(path, "rb") as file:
            return cls(file.read())


def merged(text: str, pieces: Pieces) -> list[list[str]]:
    """BPE as defined: the best-scored neighbours merge first, the leftmost of equals.  The parts after every merge."""
    states = [list(text)]
    while True:
        parts, best, at = states[-1], None, -1
        for i in range(len(parts) - 1):
            found = pieces.ids.get(parts[i] + parts[i + 1])
            if found is not None and (best is None or pieces.scores[found] > best):
                best, at = pieces.scores[found], i
        if at < 0:
            return states
        states.append(parts[:at] + [parts[at] + parts[at + 1]] + parts[at + 2:])


def last_merge(piece: str, pieces: Pieces) -> tuple[str, str] | None:
    if len(piece) == 1:
        return piece, piece
    states = merged(piece, pieces)
    return tuple(states[-2]) if states[-1] == [piece] else None


def fit(left: str, right: str, pieces: Pieces) -> bool:
    """Whether merging leaves two pieces side by side.

    Undo the later of the two last merges again and again: the pair is lost if at some time the parts that touch would
    have merged with each other before what was undone.
    """
    if pieces.parts[right] is None:
        return False
    if not left:
        return True
    ids, scores, parts = pieces.ids, pieces.scores, pieces.parts
    limit = None  # score of the merge undone last, and whether the touching parts also win a draw against it
    while True:
        joint = ids.get(left + right)
        if joint is not None and (limit is None or scores[joint] > limit[0] or scores[joint] == limit[0] and limit[1]):
            return False
        a = scores[ids[left]] if len(left) > 1 else None
        b = scores[ids[right]] if len(right) > 1 else None
        if a is None and b is None:
            return True
        if b is None or a is not None and a < b:
            limit, left = (a, False), parts[left][1]
        else:
            limit, right = (b, True), parts[right][0]


class Encoder:
    """Encodes sorted distinct words, keeping the forward states of the path to the current one.

    The state of a prefix: id (-1 for a character without a piece) and length of its last piece and, for unigram
    models, its score.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.path = ""
        self.last: list[int] = [-1]
        self.size: list[int] = [0]
        self.score: list[float] = [0.0]
        self.unknown_score = min((pieces.scores[i] for i in pieces.ids.values()), default=0.0) - 10.0

    def _merging(self, word: str, begin: int) -> None:
        """Extend the path by the characters from ``begin`` on, by what merging leaves."""
        pieces, last, sizes = self.pieces, self.last, self.size
        get, tails, fits, names = pieces.ids.get, pieces.tails.get, pieces.fits, pieces.names
        for end in range(begin + 1, len(word) + 1):
            for size in tails(word[end - 3:end], SHORT) if end > 2 else SHORT:
                i = get(word[end - size:end]) if size <= end else None
                if i is not None:
                    before = last[end - size]
                    pair = before << 32 | i
                    known = fits.get(pair)
                    if known is None:
                        known = fits[pair] = fit(names[before] if before >= 0 else "", names[i], pieces)
                    if known:
                        break
            else:
                i = -1
            last.append(i)
            sizes.append(size)

    def _scoring(self, word: str, begin: int) -> None:
        """Extend the path by the characters from ``begin`` on, by the largest sum of scores; the longest of equals."""
        get, tails, scores = self.pieces.ids.get, self.pieces.tails.get, self.pieces.scores
        for end in range(begin + 1, len(word) + 1):
            best, chosen, length = None, -1, 1
            for size in tails(word[end - 3:end], SHORT) if end > 2 else SHORT:
                i = get(word[end - size:end]) if size <= end else None
                if i is not None or size == 1:
                    total = self.score[end - size] + (self.unknown_score if i is None else scores[i])
                    if best is None or total > best:
                        best, chosen, length = total, -1 if i is None else i, size
            self.last.append(chosen)
            self.size.append(length)
            self.score.append(best)

    def encode(self, word: str) -> list[int]:
        path, last, size = self.path, self.last, self.size
        shared = min(len(path), len(word))
        if word[:shared] != path[:shared]:
            shared = 0
            while path[shared] == word[shared]:
                shared += 1
        del last[shared + 1:], size[shared + 1:], self.score[shared + 1:]
        self.path = word
        (self._merging if self.pieces.is_bpe else self._scoring)(word, shared)
        out, end = [], len(word)
        while end:
            i = last[end]
            end -= size[end]
            if i >= 0:
                out.append(i)
            elif self.pieces.bytes:
                out.extend(self.pieces.bytes[b] for b in reversed(word[end].encode("utf-8", "surrogatepass")))
            elif out[-1:] != [self.pieces.unknown]:  # neighbours without pieces share one id
                out.append(self.pieces.unknown)
        out.reverse()
        return out


class Codec:
    """Word codes of one worker.  Words seen before keep their ids until ``KEPT_WORDS`` are held."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.words: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.begin = np.zeros(1, np.int64)

    def _codes(self, distinct: list[str]) -> np.ndarray:
        if len(self.words) > KEPT_WORDS:
            self.words, self.flat, self.begin = {}, self.flat[:0], self.begin[:1]
        if len(self.pieces.fits) > KEPT_FITS:
            self.pieces.fits.clear()
        encoder = Encoder(self.pieces)
        added: list[int] = []
        ends: list[int] = []
        for word in sorted(set(distinct).difference(self.words)):
            added.extend(encoder.encode(word))
            ends.append(len(added))
            self.words[word] = len(self.words)
        self.flat = np.concatenate([self.flat, np.asarray(added, np.int32)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.asarray(ends, np.int64)])
        return np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text begins."""
        prefix = b" " if self.pieces.dummy_prefix else b""
        coded = [prefix + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in coded])])
        data = b"".join(coded)
        if not data:
            return self.flat[:0], ends * 0
        space = np.frombuffer(data, np.uint8) == 32
        starts = space.copy()
        starts[1:] &= ~space[:-1]
        starts[ends[:-1][np.diff(ends) > 0]] = True
        at = np.flatnonzero(starts)
        offsets = pa.array(np.append(at, len(data)), pa.int64())
        words = pa.LargeStringArray.from_buffers(len(at), offsets.buffers()[1], pa.py_buffer(data)).dictionary_encode()
        code = self._codes(words.dictionary.to_pylist())[np.asarray(words.indices)]
        ids, sizes = ranges(self.flat, self.begin, code)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(at, ends)]


def ranges(values: np.ndarray, begin: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each code's range, one after another, and the length of each."""
    sizes = begin[code + 1] - begin[code]
    first = np.cumsum(sizes) - sizes
    return values[np.arange(int(sizes.sum())) + np.repeat(begin[code] - first, sizes)], sizes


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", output: str = "ids") -> DataFrame:
    """``docs`` with ``output``, the ids of ``text``: null for null, none for empty text.  A column of that name is replaced."""
    docs = docs.drop(output)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*docs.schema.fields, T.StructField(output, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec = sent.value.codec or Codec(sent.value)  # outlives the task in a worker that is used again
        for batch in text_chunks(batches, text):
            texts = batch.column(text).to_pylist()
            ids, begin = codec.encode(texts)
            nulls = pa.array([t is None for t in texts])
            lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()), mask=nulls)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, output])

    return docs.mapInArrow(run, schema)


class Decoder:
    """Surfaces of all pieces in one array."""

    def __init__(self, pieces: Pieces) -> None:
        self.known, self.unknown = len(pieces.surface), pieces.unknown
        self.flat = np.frombuffer(b"".join(pieces.surface), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(s) for s in pieces.surface])])
        self.skip = 1 if pieces.dummy_prefix else 0

    def texts(self, code: np.ndarray, begin: np.ndarray) -> Iterator[str]:
        """The texts of runs of ids; what is no id is left out."""
        known = (code >= 0) & (code < self.known)
        bytes_, sizes = ranges(self.flat, self.begin, np.where(known, code, self.unknown))
        if not known.all():
            bytes_ = bytes_[np.repeat(known, sizes)]
            sizes = np.where(known, sizes, 0)
        ends = np.concatenate([[0], np.cumsum(sizes)])[begin].tolist()
        data = bytes_.tobytes()
        for low, high in zip(ends, ends[1:]):
            piece = data[low:high]
            yield (piece[self.skip:] if piece[:1] == b" " else piece).decode("utf-8", "replace")


def decode(docs: DataFrame, pieces: Pieces, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """``docs`` with ``output``, the text of ``ids``: null for null.  Null ids and ids the model lacks are left out."""
    docs = docs.drop(output)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*docs.schema.fields, T.StructField(output, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODED_ROWS):
                batch = whole.slice(at, DECODED_ROWS)
                lists = batch.column(ids)
                counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype(np.int64)
                code = np.asarray(pa.compute.fill_null(lists.flatten(), -1)).astype(np.int64)
                texts = decoder.texts(code, np.concatenate([[0], np.cumsum(counts)]))
                texts = [None if null else t for null, t in zip(lists.is_null().to_pylist(), texts)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                                 [*batch.schema.names, output])

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, pieces: Pieces, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) with ``ids``, their number ``n_tokens``, and in ``round_trip`` whether decoding gives the text back (a
    mark in the text itself reads as a space).  Null for a null text.  Columns of these names are replaced.

    Ids are decoded where they are made, so texts pass through Python once.
    """
    new = ("ids", "n_tokens", "round_trip")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    rows = docs.select(F.col(text).alias("_text_to_encode"), *kept)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec = sent.value.codec or Codec(sent.value)
        decoder = Decoder(sent.value)
        for batch in text_chunks(batches, "_text_to_encode", ROUND_BYTES):
            texts = batch.column(0).to_pylist()
            ids, begin = codec.encode(texts)
            same = [None if t is None else t.replace(MARK, " ") == d for t, d in zip(texts, decoder.texts(ids, begin))]
            nulls = pa.array([t is None for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()), mask=nulls),
                 pa.array(np.diff(begin), pa.int64(), mask=np.asarray(nulls)), pa.array(same, pa.bool_())], schema.names)

    return rows.mapInArrow(run, schema)
