"""SentencePiece encoding and decoding with a suffix array over each batch's words."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela.llm.common import Batches, arrow_batch

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
# Piece kinds of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
# Code points of text handled at a time, of new words indexed at a time, and words remembered per process.
TEXT_AT_ONCE = 4_000_000
INDEX_AT_ONCE = 600_000
REMEMBERED = 150_000
# Rows of an Arrow batch turned into Python objects at a time.
ROWS_AT_ONCE = 256
# Words of more symbols are merged one by one with a heap.
LONG_WORD = 128
NONE = np.int64(1) << 31


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model file; plain lists, so that it can be broadcast."""

    pieces: list[str]
    ids: list[int]
    ranks: list[int]
    byte_ids: list[int]
    unknown: int
    surfaces: list[bytes]
    prefix: bool

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != BPE or model.normalizer_spec.precompiled_charsmap:
            raise ValueError("expected a BPE model without character normalisation")
        if model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("expected a model that keeps white space")
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        order = {s: r for r, s in enumerate(sorted({p.score for _, p in normal}, reverse=True))}
        byte_ids = [i for i, p in enumerate(model.pieces) if p.type == BYTE]
        surfaces = [
            p.piece.replace(SPACE, " ").encode() if p.type == NORMAL
            else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else UNKNOWN_TEXT.encode() if p.type == UNKNOWN
            else b""
            for p in model.pieces
        ]
        unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        return cls(
            [p.piece for _, p in normal], [i for i, _ in normal], [order[p.score] for _, p in normal],
            byte_ids, unknown, surfaces, model.normalizer_spec.add_dummy_prefix,
        )


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def dense_codes(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """Codes renumbered from 1 in their order, and how many there are."""
    used = np.zeros(int(codes.max(initial=0)) + 1, bool)
    used[codes] = True
    return np.cumsum(used)[codes], int(used.sum())


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of the ``depth`` symbols that follow: symbols are packed, then ranks doubled."""
    dense, alphabet = dense_codes(codes)
    bits = max(1, alphabet.bit_length())
    covered = min(depth, 62 // bits)

    def ahead(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        out[: max(0, len(values) - by)] = values[by:]
        return out

    key = np.zeros(len(codes), np.int64)
    for j in range(covered):
        key = (key << bits) | ahead(dense, j)
    while covered < depth:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        key = rank * np.int64(len(key) + 2) + ahead(rank, covered)
        covered *= 2
    return np.argsort(key)


class Edges:
    """Piece occurrences by position: which lengths start there, and the piece of each."""

    def __init__(self, position: np.ndarray, length: np.ndarray, piece: np.ndarray, size: int, depth: int):
        self.depth, self.piece = depth, piece
        # One bit for each length; set bits below a length count the edges before it.
        self.lengths = np.bincount(position, weights=np.exp2(length), minlength=size).astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(position, minlength=size))])

    def find(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece number of the edge from start to end, or -1."""
        length = end - start
        bit = np.uint64(1) << np.minimum(length, self.depth + 1).astype(np.uint64)
        mask = self.lengths[start]
        at = self.first[start] + np.bitwise_count(mask & (bit - np.uint64(1)))
        hit = (mask & bit) != 0
        return np.where(hit, self.piece[np.where(hit, at, 0)], -1) if len(self.piece) else np.full(len(start), -1)


class Encoder:
    """Encodes words of a vocabulary batch by batch and remembers frequent ones."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.depth = max(map(len, vocabulary.pieces))
        lengths = np.array([len(p) for p in vocabulary.pieces])
        table = np.zeros((len(lengths), self.depth), np.uint32)
        for i, piece in enumerate(vocabulary.pieces):
            table[i, : len(piece)] = codes_of(piece)
        self.table, self.lengths = table, lengths
        self.ids, self.ranks = np.array(vocabulary.ids), np.array(vocabulary.ranks)
        # Characters of no piece end a word; a space inside a word does too, if no piece has one after another sign.
        inside = any(SPACE in p.lstrip(SPACE) for p in vocabulary.pieces)
        line_ends = "" if any("\n" in p for p in vocabulary.pieces) else "\n"
        self.splitter = re.compile(".+" if inside else f" *[^ {line_ends}]+|{line_ends or '(?!)'}| +", re.DOTALL)
        self.known: dict[str, bytes] = {}

    def ranges(self, codes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Binary search of every piece in the suffix array: piece numbers and the ranges of their occurrences.

        Pieces with a character that the text lacks have none.
        """
        used = np.zeros(max(int(codes.max(initial=0)), int(self.table.max())) + 1, bool)
        used[codes] = used[0] = True
        rows = np.nonzero(used[self.table].all(axis=1))[0]
        table, lengths = self.table[rows], self.lengths[rows]
        padded = np.concatenate([codes, np.zeros(self.depth, np.uint32)])
        within = np.arange(self.depth) < lengths[:, None]
        place = np.arange(len(rows))

        def bound(after_equal: bool) -> np.ndarray:
            low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
            while (open_ := low < high).any():
                mid = (low + high) // 2
                seen = padded[order[np.minimum(mid, len(order) - 1)][:, None] + np.arange(self.depth)] * within
                differ = seen != table
                at = differ.argmax(axis=1)
                less = seen[place, at] < table[place, at]
                right = np.where(differ[place, at], less, after_equal) & open_
                low, high = np.where(right, mid + 1, low), np.where(right | ~open_, high, mid)
            return low

        return rows, bound(False), bound(True)

    def edges(self, codes: np.ndarray) -> Edges:
        """All occurrences of all pieces, sorted by position and length."""
        order = suffix_array(codes, self.depth)
        rows, low, high = self.ranges(codes, order)
        counts = high - low
        piece = np.repeat(rows, counts)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        position = order[np.repeat(low, counts) + inside]
        length = self.lengths[piece]
        by_position = np.argsort(position * np.int64(self.depth + 1) + length)
        return Edges(position[by_position], length[by_position], piece[by_position], len(codes), self.depth)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as 32-bit numbers.

        Every symbol starts as one character. The relaxation takes in each round, for every word at once, the edge with
        the best score (then the leftmost) that spans two neighbouring symbols, and makes them one, until no edge
        spans two. Characters without a piece become their UTF-8 bytes.
        """
        codes = codes_of(SPACE.join([w.replace(" ", SPACE) for w in words]))
        sizes = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        edges = self.edges(codes)
        word = np.repeat(np.arange(len(words)), sizes)
        start = np.repeat(first, sizes) + np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = start + 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for w in np.nonzero(sizes > LONG_WORD)[0]:
            own = self.merge_long(int(first[w]), int(first[w] + sizes[w]), edges)
            done.append((np.full(len(own) - 1, w), own[:-1], own[1:]))
        short = sizes[word] <= LONG_WORD
        word, start, end = word[short], start[short], end[short]
        while len(word):
            # Edge over this symbol and the next one of its word.
            pair = np.zeros(len(word), bool)
            pair[:-1] = word[:-1] == word[1:]
            at = np.nonzero(pair)[0]
            found = edges.find(start[at], end[at + 1])
            rank = np.full(len(word), NONE)
            rank[at] = np.where(found >= 0, self.ranks[found], NONE)
            head = np.nonzero(np.concatenate([[True], word[1:] != word[:-1]]))[0]
            best = np.minimum.reduceat((rank << 31) | np.arange(len(word)), head)
            going = (best >> 31) < NONE
            merged = best[going] & ((1 << 31) - 1)
            end[merged] = end[merged + 1]
            active = np.repeat(going, np.diff(np.append(head, len(word))))
            done.append((word[~active], start[~active], end[~active]))
            stays = active
            stays[merged + 1] = False
            word, start, end = word[stays], start[stays], end[stays]
        word, start, end = [np.concatenate(x) for x in zip(*done, strict=True)]
        by_start = np.argsort(start, kind="stable")
        word, start, end = word[by_start], start[by_start], end[by_start]
        found = edges.find(start, end)
        ids = np.where(found >= 0, self.ids[found], -1).astype(np.int32)
        cuts = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        data = ids.tobytes()
        out = [data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for w in np.unique(word[found < 0]):
            a, b = cuts[w], cuts[w + 1]
            out[w] = self.with_bytes(codes, start[a:b], ids[a:b])
        return out

    def with_bytes(self, codes: np.ndarray, start: np.ndarray, ids: np.ndarray) -> bytes:
        out: list[int] = []
        for s, i in zip(start, ids, strict=True):
            if i >= 0:
                out.append(int(i))
            elif self.v.byte_ids:
                out.extend(self.v.byte_ids[b] for b in chr(codes[s]).encode("utf-8", "surrogatepass"))
            else:
                out.append(self.v.unknown)
        return np.array(out, np.int32).tobytes()

    def merge_long(self, begin: int, stop: int, edges: Edges) -> np.ndarray:
        """Symbol borders of one long word: the same relaxation with a heap of edges instead of rounds."""
        wide = self.depth + 1
        ranks: dict[int, int] = {}
        for size in range(2, wide):
            starts = np.arange(begin, stop - size + 1)
            found = edges.find(starts, starts + size)
            have = found >= 0
            ranks.update(zip((starts[have] * wide + size).tolist(), self.ranks[found[have]].tolist(), strict=True))
        after = {s: s + 1 for s in range(begin, stop)}
        before = {s + 1: s for s in range(begin, stop)}
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            middle = after.get(left, stop)
            if middle < stop:
                right = after[middle]
                rank = ranks.get(left * wide + right - left) if right - left <= self.depth else None
                if rank is not None:
                    heapq.heappush(heap, (rank, left, middle, right))

        for s in range(begin, stop - 1):
            offer(s)
        while heap:
            _, left, middle, right = heapq.heappop(heap)
            if after.get(left) != middle or after.get(middle) != right:
                continue
            after[left] = right
            before[right] = left
            del after[middle]
            offer(left)
            if left > begin:
                offer(before[left])
        return np.array([*sorted(after), stop], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        prefix = " " if self.v.prefix else ""
        known = self.known
        parts = [self.splitter.findall(prefix + t.replace(SPACE, " ")) if t else [] for t in texts]
        present = {w for p in parts for w in p}
        if len(known) > REMEMBERED:
            # Words of the batch at hand stay: frequent ones are always among them.
            known = self.known = {w: known[w] for w in present & known.keys()}
        new = present - known.keys()
        batch: list[str] = []
        size = 0
        for word in new:
            batch.append(word)
            size += len(word) + 1
            if size >= INDEX_AT_ONCE:
                known.update(zip(batch, self.encode_words(batch), strict=True))
                batch, size = [], 0
        if batch:
            known.update(zip(batch, self.encode_words(batch), strict=True))
        return [b"".join([known[w] for w in p]) for p in parts]


ID_FIELDS = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]

_encoders: dict[int, Encoder] = {}


def process_encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder for a worker process, so words stay known from task to task."""
    number = hash((len(vocabulary.pieces), *vocabulary.pieces[:100], *vocabulary.pieces[-100:]))
    if number not in _encoders:
        _encoders.clear()
        _encoders[number] = Encoder(vocabulary)
    return _encoders[number]


def slices(column: pa.Array):
    """``start, texts`` of a column's rows, few enough at a time to hold as Python strings."""
    held: list[str | None] = []
    begin = size = 0
    for at in range(0, len(column), ROWS_AT_ONCE):
        for text in column.slice(at, ROWS_AT_ONCE).to_pylist():
            if held and size + len(text or "") > TEXT_AT_ONCE:
                yield begin, held
                begin, size, held = begin + len(held), 0, []
            held.append(text)
            size += len(text or "")
    if held:
        yield begin, held


def encoded(batches: Batches, vocabulary: Vocabulary, rest: list[str]) -> Batches:
    """Batches of the ``rest`` columns and a text, with ids and their number in place of the text."""
    encoder = process_encoder(vocabulary)
    for batch in batches:
        for start, texts in slices(batch.column(len(rest))):
            found = encoder.encode([t or "" for t in texts])
            lengths = np.array([len(f) // 4 for f in found], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            values = pa.array(np.frombuffer(b"".join(found), np.int32))
            kept = [batch.column(i).slice(start, len(texts)) for i in range(len(rest))]
            yield arrow_batch([*rest, "ids", "n_tokens"], [*kept, pa.ListArray.from_arrays(offsets, values), pa.array(lengths)])


def decode_ids(ids: np.ndarray, surfaces: np.ndarray, prefix: bool) -> str:
    """Text of piece ids; ``surfaces`` holds the bytes of every piece."""
    data = b"".join(surfaces[ids].tolist())
    if prefix and data.startswith(b" "):
        data = data[1:]
    return data.decode("utf-8", "replace")


def decoded(batches: Batches, vocabulary: Vocabulary) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches with a column ``ids``, a few rows at a time, each with the texts of its rows."""
    surfaces = np.array(vocabulary.surfaces, object)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            ids = part.column("ids")
            values, cuts = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            yield part, [decode_ids(values[a:b], surfaces, vocabulary.prefix) for a, b in zip(cuts, cuts[1:], strict=False)]


def encode(docs: DataFrame, text: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``docs`` with ``ids`` in place of ``text`` and ``n_tokens``.

    The ids are those of the public library for the same model. Null and empty texts have no ids; repeated rows
    each get theirs; an input column called ``ids`` or ``n_tokens`` is replaced. A text is handled whole, one after
    another, and words are shared between the texts of a batch.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_file))
    rest = [c for c in docs.columns if c not in (text, "ids", "n_tokens")]
    kind = T.StructType([*[docs.schema[c] for c in rest], *ID_FIELDS])
    return docs.select(*rest, text).mapInArrow(lambda batches: encoded(batches, shipped.value, rest), kind)


def decode(rows: DataFrame, text: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``rows`` with ``text`` put together from ``ids``; null ids give an empty text.

    Encoding turns the sign U+2581 into a blank, so texts holding it come back with blanks; all others come back as
    they were. Byte sequences that are no UTF-8 give replacement characters.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(Vocabulary.read(model_file))
    rest = [c for c in rows.columns if c != text]

    def run(batches: Batches):
        for part, texts in decoded(batches, shipped.value):
            yield arrow_batch([*rest, text], [*part.columns, pa.array(texts, pa.string())])

    kind = T.StructType([*[rows.schema[c] for c in rest], T.StructField(text, T.StringType())])
    return rows.select(*rest).mapInArrow(run, kind)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``key, ids, n_tokens, text_sha256`` (of the decoded text) and ``exact``: it equals the source.

    Encoding and decoding run in one Python process per task, so ids do not travel in between.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_file))
    source = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("source")

    def run(batches: Batches):
        v = shipped.value
        for part, texts in decoded(encoded(batches, v, ["id", "source"]), v):
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            exact = pa.array([d == s for d, s in zip(digests, part.column("source").to_pylist(), strict=True)])
            yield arrow_batch(["id", "ids", "n_tokens", "text_sha256", "exact"], [part.column(0), part.column(2), part.column(3), pa.array(digests), exact])

    fields = [T.StructField("id", docs.schema[key].dataType), *ID_FIELDS, T.StructField("text_sha256", T.StringType()), T.StructField("exact", T.BooleanType())]
    rows = docs.select(F.col(key).alias("id"), source, F.col(text).alias("text"))
    return rows.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", key)
