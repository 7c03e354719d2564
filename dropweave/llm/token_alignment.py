"""Where the tokens of two tokenizers meet: groups, links and how common a link is in the corpus.

Tokenizer A is a byte-level BPE and gets a space and the text, tokenizer B is a SentencePiece model that adds the space itself.  Byte offsets where a
token of either ends cut the tokens into groups.  Two tokens are linked where their bytes overlap.  Every stretch between two
neighbouring ends of any kind belongs to one token of A and one of B, so the ends are the links.

Fragments.  A run of tokens of a document is a fragment: an open head (up to its first shared end), closed groups, and an open
tail (from its last shared end on); without a shared end all of it is head.  Two neighbours compose: the tokens between the left one's last and the right one's
first shared end are cut anew, and so on; which pairs are composed first makes no difference.

* A space between two characters that are no white space ends a token of A and of B.  Such words are fragments closed on both
  sides; distinct ones are encoded once per task and kept up to ``KEPT_WORDS``.
* Documents beyond ``CHUNK`` bytes are cut into byte ranges, which are dealt over all tasks.  A range has the tokens that end in it,
  encoded from the last word border before the range to the first one behind it; A and B tokens over its border fall on either side, so
  fragments have open ends.  Rounds of ``ARITY`` neighbours compose them, as a tree, into one.  A range without a word border is joined with the next one, so
  text is encoded twice at most.

The corpus counts of linked pairs are added up in the JVM.  They come back to the documents as sorted arrays while the pairs are at most ``BROADCAST_PAIRS`` (counted
first), and by a join of documents' pairs beyond.

Null and empty texts, and texts whose tokens do not give back their bytes (with U+2581, say), have no tokens.  Every row is a document of its own, also with a
null or repeated id; equal texts count once each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropweave.llm._byte_bpe import byte_level
from dropweave.llm._common import text_chunks
from dropweave.session import staging_path

CHUNK = 64 * 1024
ARITY = 16
KEPT_WORDS = 200_000
BROADCAST_PAIRS = 4_000_000
MARK = "▁"
#: A space between characters that are no white space.
BORDER = re.compile(r" (?<=\S )(?=\S)")


class Tokenizers:
    """Both tokenizers from the bytes of their files, built once in each process.

    A: the vocabulary and merges of a byte-level BPE file whose ids follow its merges (so an id is a rank) and whose special tokens
    are not used.  B: a SentencePiece model in which no piece goes on after a space.  Other files are a ``ValueError``.
    """

    def __init__(self, vocabulary: bytes, model: bytes) -> None:
        self.vocabulary, self.model = vocabulary, model
        self._built: tuple | None = None

    @classmethod
    def load(cls, vocabulary: str, model: str) -> Tokenizers:
        return cls(Path(vocabulary).read_bytes(), Path(model).read_bytes())

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_built": None}

    @property
    def built(self) -> tuple:
        """Both encoders, and the bytes of every id of either."""
        if self._built is None:
            import sentencepiece
            a, bytes_a = byte_level(self.vocabulary)
            b = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            bytes_b = []
            for i in range(b.vocab_size()):
                piece = b.id_to_piece(i)
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} goes on after a space")
                bytes_b.append(bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i)
                               else piece.replace(MARK, " ").encode())
            self._built = a, b, bytes_a, bytes_b
        return self._built

    @property
    def sizes(self) -> tuple[int, int]:
        return len(self.built[2]), len(self.built[3])


def cut(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared ends of two ascending rows of ends, and of each link the place of its A and its B token."""
    ends = np.union1d(ends_a, ends_b)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return shared, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def group_texts(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, shared: np.ndarray, names: list[str], first_b: int) -> list[str]:
    """The tokens of all groups in order as text pieces that end with what separates them from the next token.

    ``names`` has three pieces for each id (of A, then of B): with a comma, a bar and a semicolon.
    """
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    last_a = np.append(group_a[1:] != group_a[:-1], True) if len(a) else np.zeros(0, bool)
    last_b = np.append(group_b[1:] != group_b[:-1], True) if len(b) else np.zeros(0, bool)
    pieces = np.empty(len(a) + len(b), np.int64)
    pieces[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = 3 * a + last_a
    pieces[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 3 * (b + first_b) + 2 * last_b
    return list(map(names.__getitem__, pieces.tolist()))


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of runs, one run after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Words:
    """Distinct words of a task with their tokens, groups and links as flat rows."""

    def __init__(self, both: Tokenizers) -> None:
        self.a, self.b, self.bytes_a, self.bytes_b = both.built
        self.length_a, self.length_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{end}" for table in (self.bytes_a, self.bytes_b) for i in range(len(table)) for end in ",|;"]
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.texts: list[str] = []  # groups of a word
        self.n = {k: np.zeros(0, np.int64) for k in ("a", "b", "codes", "groups", "ok", "border")}
        self.flat = {k: np.zeros(0, np.int64) for k in ("a", "b", "codes")}
        self.start: dict[str, np.ndarray] = {}

    def add(self, new: list[str]) -> None:
        """Encode words not seen yet."""
        ids_a = [self.a.encode_ordinary(" " + w) for w in new]
        ids_b = self.b.encode(new, num_threads=1)
        ok = np.ones(len(new), bool)
        for i, w in enumerate(new):
            said = b" " + w.encode("utf-8", "replace")
            if (b"".join(map(self.bytes_a.__getitem__, ids_a[i])) != said or b"".join(map(self.bytes_b.__getitem__, ids_b[i])) != said):
                ok[i], ids_a[i], ids_b[i] = False, [], []
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter((t for ids in table for t in ids), np.int64, int(n.sum())) for table, n in ((ids_a, n_a), (ids_b, n_b)))
        # One after the other the words are one run of tokens, with a shared end behind each.
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        shared, left, right = cut(ends_a, ends_b)
        word_a, word_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        codes = a[left] * len(self.bytes_b) + b[right]
        n_groups = np.bincount(word_a[np.searchsorted(ends_a, shared)], minlength=len(new)) if len(a) else np.zeros(len(new), np.int64)
        pieces, at = group_texts(a, b, ends_a, ends_b, shared, self.names, len(self.bytes_a)), 0
        for size in (n_a + n_b).tolist():
            self.texts.append("".join(pieces[at:at + size])[:-1])
            at += size
        border = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in new), bool, len(new))
        for k, v in {"a": n_a, "b": n_b, "codes": np.bincount(word_a[left], minlength=len(new)) if len(a) else np.zeros(len(new), np.int64),
                     "groups": n_groups, "ok": ok, "border": border}.items():
            self.n[k] = np.concatenate([self.n[k], v.astype(np.int64)])
        for k, v in {"a": a, "b": b, "codes": codes}.items():
            self.flat[k] = np.concatenate([self.flat[k], v])
            self.start[k] = np.cumsum(self.n[k]) - self.n[k]

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words of every text in order, as places in the rows, and their number per text."""
        if len(self.place) > KEPT_WORDS:
            self.clear()

        def look_up(rows: list[list[str]]) -> np.ndarray:
            new = [w for w in dict.fromkeys(chain.from_iterable(rows)) if w not in self.place]
            if new:
                self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
                self.add(new)
            return np.array(list(map(self.place.__getitem__, chain.from_iterable(rows))), np.int64)

        # Nearly all spaces are borders: texts with others are told by a word that is empty or has white space at an end.
        split = [t.split(" ") for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        found = look_up(split)
        again = np.flatnonzero(np.maximum.reduceat(self.n["border"][found], np.cumsum(counts) - counts)) if len(texts) else counts
        if len(again):
            for i in again.tolist():
                split[i] = BORDER.split(texts[i])
            found = look_up(split)
            counts = np.fromiter(map(len, split), np.int64, len(split))
        return found, counts

    def take(self, kind: str, words: np.ndarray) -> np.ndarray:
        return self.flat[kind][_spread(self.start[kind][words], self.n[kind][words])]


def _schema(n_codes: int) -> T.StructType:
    """What a document comes to; codes are id of A * ids of B + id of B."""
    return T.StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                f"codes array<{'int' if n_codes < 2**31 else 'long'}>, times array<int>")


def _lists(counts: np.ndarray, values: np.ndarray, kind: T.DataType) -> pa.Array:
    inner = pa.int32() if isinstance(kind.elementType, T.IntegerType) else pa.int64()
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, inner))


def whole(words: Words, texts: list[str], schema: T.StructType) -> list[pa.Array]:
    """The columns of ``_schema`` for texts of one task."""
    place, counts = words.places([t or "" for t in texts])
    begin, size = np.cumsum(counts) - counts, words.n
    ok = np.minimum.reduceat(size["ok"][place], begin) * np.fromiter(map(bool, texts), np.int64, len(texts)) if len(texts) else counts

    def added(kind: str) -> np.ndarray:
        return np.add.reduceat(size[kind][place], begin) * ok if len(texts) else counts

    listed, shas = place.tolist(), []
    for first, n, good in zip(begin.tolist(), counts.tolist(), ok.tolist()):
        shas.append(hashlib.sha256(";".join(map(words.texts.__getitem__, listed[first:first + n])).encode()).hexdigest() if good else "")
    kept = place[np.repeat(ok, counts) > 0]
    doc = np.repeat(np.repeat(np.arange(len(texts)), counts * ok), words.n["codes"][kept])
    n_codes = len(words.bytes_a) * len(words.bytes_b)
    key, times = np.unique(doc * n_codes + words.take("codes", kept), return_counts=True)
    per_doc = np.bincount(key // n_codes, minlength=len(texts))
    return [*(pa.array(added(k)) for k in ("a", "b", "groups", "codes")), pa.array(shas, pa.string()),
            _lists(per_doc, key % n_codes, schema["codes"].dataType), _lists(per_doc, times, schema["times"].dataType)]


@dataclass
class Fragment:
    """A run of tokens of one document.  The head begins at ``from_a`` and ``from_b``, the tail at ``tail_from``; offsets count bytes of the document."""

    from_a: int
    from_b: int
    head_a: np.ndarray
    head_b: np.ndarray
    ok: bool = True
    closed: bool = False  # whether there is a shared end
    tail_from: int = 0
    tail_a: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    tail_b: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_a: int = 0  # tokens, groups, links and text of the closed groups between head and tail
    n_b: int = 0
    n_groups: int = 0
    text: str = ""
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


FRAGMENT = ("from_a long, from_b long, head_a array<long>, head_b array<long>, ok boolean, closed boolean, tail_from long, tail_a array<long>, "
            "tail_b array<long>, n_a long, n_b long, n_groups long, text string, codes array<long>, times array<long>")


class Aligner:
    """Makes and composes fragments."""

    def __init__(self, both: Tokenizers) -> None:
        _, _, table_a, table_b = both.built
        self.length_a, self.length_b = (np.array([len(t) for t in table], np.int64) for table in (table_a, table_b))
        self.names = [f"{i}{end}" for table in (table_a, table_b) for i in range(len(table)) for end in ",|;"]

    def closed(self, a: np.ndarray, b: np.ndarray) -> Fragment:
        """Groups of tokens that begin and end together, as the closed part of a fragment."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        shared, left, right = cut(ends_a, ends_b)
        codes, times = np.unique(a[left] * len(self.length_b) + b[right], return_counts=True)
        text = "".join(group_texts(a, b, ends_a, ends_b, shared, self.names, len(self.length_a)))[:-1]
        none = np.zeros(0, np.int64)
        return Fragment(0, 0, none, none, n_a=len(a), n_b=len(b), n_groups=len(shared), text=text, codes=codes, times=times)

    def open(self, from_a: int, from_b: int, a: np.ndarray, b: np.ndarray, ok: bool = True) -> Fragment:
        """The fragment of a run of tokens."""
        ends_a, ends_b = from_a + np.cumsum(self.length_a[a]), from_b + np.cumsum(self.length_b[b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not len(shared):
            return Fragment(from_a, from_b, a, b, ok)
        first_a, last_a = np.searchsorted(ends_a, shared[[0, -1]]) + 1
        first_b, last_b = np.searchsorted(ends_b, shared[[0, -1]]) + 1
        out = self.closed(a[first_a:last_a], b[first_b:last_b])
        out.from_a, out.from_b, out.ok, out.closed, out.tail_from = from_a, from_b, ok, True, int(shared[-1])
        out.head_a, out.head_b, out.tail_a, out.tail_b = a[:first_a], b[:first_b], a[last_a:], b[last_b:]
        return out

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """Associative."""
        if left.closed:
            middle = self.open(left.tail_from, left.tail_from, np.concatenate([left.tail_a, right.head_a]), np.concatenate([left.tail_b, right.head_b]))
            parts = [left, self.closed(middle.head_a, middle.head_b), middle] if middle.closed else [left]
        else:
            middle = self.open(left.from_a if len(left.head_a) else right.from_a, left.from_b if len(left.head_b) else right.from_b, np.concatenate([left.head_a, right.head_a]), np.concatenate([left.head_b, right.head_b]))
            parts = [middle]
        first = left if left.closed else middle
        last = right if right.closed else middle
        parts += [right] if right.closed else []
        out = Fragment(first.from_a, first.from_b, first.head_a, first.head_b, left.ok and right.ok, first.closed)
        if out.closed:
            out.tail_from, out.tail_a, out.tail_b = (last.tail_from, last.tail_a, last.tail_b) if last.closed else (
                left.tail_from, middle.head_a, middle.head_b)
        out.n_a, out.n_b, out.n_groups = (sum(getattr(p, k) for p in parts) for k in ("n_a", "n_b", "n_groups"))
        out.text = ";".join(p.text for p in parts if p.text)
        out.codes, place = np.unique(np.concatenate([p.codes for p in parts]), return_inverse=True)
        out.times = np.bincount(place, np.concatenate([p.times for p in parts]), len(out.codes)).astype(np.int64)
        return out

    def finish(self, all_: Fragment) -> Fragment:
        """A whole document: its head begins where the text begins, so it is a closed group too."""
        return self.compose(Fragment(0, 0, all_.head_a[:0], all_.head_b[:0], closed=True), all_)


def ranges(text: str, chunk: int) -> list[tuple[int, int, int, str]]:
    """``(from, to, start, text)`` of the byte ranges of a long text.

    A range has the tokens that end behind ``from`` and not behind ``to``, in bytes of a space and the text.  The slice, which begins
    at byte ``start`` with a space that is left out, goes from the last border up to ``from`` to the first one from ``to`` on.
    """
    data = text.encode("utf-8", "replace")
    places = [m.start() for m in BORDER.finditer(text)]
    at_byte = np.zeros(len(places), np.int64)
    if places:
        # Bytes before each border: characters and their continuation bytes.
        widths = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        at_byte = np.searchsorted(widths, np.array(places) + 1)
    size = len(data) + 1
    borders = np.concatenate([[0], at_byte + 1, [size]])  # in bytes of a space and the text
    out, begin = [], 0
    for end in [*range(chunk, size, chunk), size]:
        if end < size and not np.searchsorted(borders, end, "right") - np.searchsorted(borders, begin, "right"):
            continue  # no border inside: the next range takes it along
        low = borders[np.searchsorted(borders, begin, "right") - 1] if begin else 0
        high = borders[np.searchsorted(borders, end, "left")]
        out.append((begin, end, int(low), data[low:high - 1].decode("utf-8", "replace")))
        begin = end
    return out


def _written(df: DataFrame, name: str) -> DataFrame:
    """As ``stage``, packed tighter: long rows of numbers."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fragments(table: pa.Table) -> list[Fragment]:
    names = [f.strip().split()[0] for f in FRAGMENT.split(",")]
    rows = []
    for row in table.select(names).to_pylist():
        rows.append(Fragment(**{k: np.array(v, np.int64) if isinstance(v, list) else v for k, v in row.items()}))
    return rows


def long_documents(docs: DataFrame, both: Tokenizers, schema: T.StructType, chunk: int) -> DataFrame:
    """``doc_id`` and the columns of ``schema`` for rows ``(doc_id, text)`` too long for one task."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(both)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            for doc, row, text in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cuts = list(zip(*ranges(text, chunk)))
                n = len(cuts[0])
                yield pa.RecordBatch.from_arrays([pa.repeat(doc, n), pa.repeat(pa.scalar(row, pa.int64()), n), pa.array(range(n), pa.int64()),
                                                  *(pa.array(c, t) for c, t in zip(cuts, (pa.int64(),) * 3 + (pa.string(),)))],
                                                 ["doc_id", "row", "seq", "begin", "end", "start", "text"])

    dealt = _written(docs.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", "text").mapInArrow(
        pieces, f"doc_id {kind}, row long, seq long, begin long, end long, start long, text string"), "text-ranges")
    most = dealt.agg(F.max("seq")).first()[0]
    key = f"doc_id {kind}, row long, seq long, "
    names = [f.name for f in T.StructType.fromDDL(FRAGMENT)]

    def packed(ids: list[pa.Array], found: list[Fragment]) -> pa.RecordBatch:
        columns = [pa.array([getattr(f, n) for f in found], t) for n, t in zip(names, (
            pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64()),
            pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
        return pa.RecordBatch.from_arrays([*ids, *columns], ["doc_id", "row", "seq", *names])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, align = Words(sent.value), Aligner(sent.value)
        for batch in text_chunks(batches, "text"):
            found = []
            for begin, end, start, text in zip(*(batch.column(i).to_pylist() for i in range(3, 7))):
                place, _ = words.places([text])
                tokens, starts = [], []
                for side, length in (("a", align.length_a), ("b", align.length_b)):
                    ids = words.take(side, place)
                    ends = start + np.cumsum(length[ids])
                    kept = (ends > begin) & (ends <= end)
                    tokens.append(ids[kept])
                    starts.append(int((ends - length[ids])[kept][0]) if kept.any() else begin)
                found.append(align.open(*starts, *tokens, ok=bool(words.n["ok"][place].all())))
            yield packed(batch.columns[:3], found)

    def folded(table: pa.Table) -> pa.Table:
        align, table = Aligner(sent.value), table.sort_by("seq")
        ids = [table.column(c).combine_chunks()[:1] for c in ("doc_id", "row")]
        seq = pa.array([table.column("seq")[0].as_py() // ARITY], pa.int64())
        return pa.Table.from_batches([packed([*ids, seq], [reduce(align.compose, _fragments(table))])])

    found = _written(dealt.repartition("row", "seq").mapInArrow(leaves, key + FRAGMENT), "fragments")
    while most:
        found = _written(found.withColumn("node", F.expr(f"seq div {ARITY}")).groupBy("row", "node").applyInArrow(
            lambda _, table: folded(table), key + FRAGMENT), "fragments")
        most //= ARITY

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(sent.value)
        for batch in batches:
            done = [align.finish(f) for f in _fragments(pa.Table.from_batches([batch]))]
            none = Fragment(0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))
            done = [f if f.ok else none for f in done]
            counts = np.array([len(f.codes) for f in done], np.int64)
            codes, times = (np.concatenate([np.zeros(0, np.int64), *(getattr(f, k) for f in done)]) for k in ("codes", "times"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([getattr(f, k) for f in done], pa.int64()) for k in ("n_a", "n_b", "n_groups")),
                 pa.array([int(f.times.sum()) for f in done], pa.int64()),
                 pa.array([hashlib.sha256(f.text.encode()).hexdigest() if f.ok and f.text else "" for f in done], pa.string()),
                 _lists(counts, codes, schema["codes"].dataType), _lists(counts, times, schema["times"].dataType)],
                ["doc_id", *schema.names])

    return found.mapInArrow(finished, T.StructType([docs.schema["doc_id"], *schema.fields]))


def documents(docs: DataFrame, both: Tokenizers, id_column: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, codes, times)`` of every row, staged: codes are the distinct linked pairs."""
    n_a, n_b = both.sizes
    schema = _schema(n_a * n_b)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    sent = docs.sparkSession.sparkContext.broadcast(both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(sent.value)
        for batch in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), *whole(words, batch.column(1).to_pylist(), schema)], ["doc_id", *schema.names])

    short = rows.filter(~is_long).mapInArrow(run, T.StructType([rows.schema["doc_id"], *schema.fields]))
    return _written(short.union(long_documents(rows.filter(is_long), both, schema, chunk)), "aligned")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``(code, docs, best)``: documents that hold a pair linked, and whether no pair of its A token has more; staged."""
    counted = aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("docs"))
    # An A token has at most as many pairs as B has tokens.
    of_a = Window.partitionBy(F.expr(f"code div {n_b}"))
    return _written(counted.withColumn("best", F.col("docs") == F.max("docs").over(of_a)), "pair-counts")


def _looked_up(aligned: DataFrame, pairs: DataFrame, keep: list[str]) -> DataFrame:
    held = pairs.toArrow()  # as many as were counted
    order = np.argsort(np.asarray(held.column("code")))
    table = tuple(np.asarray(held.column(c))[order] for c in ("code", "docs", "best"))
    sent = aligned.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*(aligned.schema[c] for c in keep), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs, best = sent.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                listed, times = part.column("codes"), np.asarray(part.column("times").flatten())
                place = np.searchsorted(codes, np.asarray(listed.flatten()))
                limits = np.concatenate([[0], np.cumsum(np.asarray(listed.value_lengths()))])
                sums = [np.diff(np.concatenate([[0], np.cumsum(v[place] * times)])[limits]) for v in (best, docs)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(v, pa.int64()) for v in sums)], schema.names)

    return aligned.mapInArrow(run, schema)


def _joined(aligned: DataFrame, pairs: DataFrame, keep: list[str]) -> DataFrame:
    rows = _written(aligned.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    each = rows.select("_row", F.explode(F.arrays_zip("codes", "times")).alias("l")).select("_row", F.col("l.codes").alias("code"), F.col("l.times").alias("times"))
    sums = each.join(pairs, "code").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    return rows.join(sums, "_row", "left").select(*keep, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")))


def align(docs: DataFrame, both: Tokenizers, id_column: str = "doc_id", text: str = "text", chunk: int = CHUNK,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
    aligned = documents(docs, both, id_column, text, chunk)
    pairs = pair_counts(aligned, both.sizes[1])
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    how: Callable = _looked_up if pairs.count() <= broadcast_pairs else _joined
    return how(aligned, pairs, keep).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
