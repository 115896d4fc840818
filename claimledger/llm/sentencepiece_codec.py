"""Exact encoding and decoding of a merge-type SentencePiece vocabulary.

A merge encoder joins, again and again, the adjacent pair whose joined piece has the highest score, leftmost first.
Its result is the one sequence of pieces in which every piece, and every pair of neighbours, comes out of
that merging unchanged. So it is found without merging the text: walk from left to right, take the longest piece
(Aho-Corasick matches), accept it if it is compatible with the piece before it (the pair is merged anew, once, and the
answer kept), else a shorter one, and step back where none fits. A bitfield of positions that are known to fail
bounds the walk to one visit per position.

No piece of the vocabulary holds the space mark after another character, so a text falls into chunks (space marks, then
other characters) that are encoded on their own. That is checked when the vocabulary is loaded. Nor does merging cross two
neighbours that no piece holds side by side: chunks are cut where marks (punctuation, control characters and what pieces
join to them) meet other characters, so a word is the same chunk whatever mark or line end follows it.
"""

import heapq
import re
from array import array
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from claimledger.llm.common import add_columns

SPACE = "▁"

# Chunks and pairs remembered per worker process, about 100 MB, as workers go on to other stages. Pairs are emptied when
# full. Chunks are held in two halves: when the younger is full, the older goes, and what is used again stays.
REMEMBERED_CHUNKS = 200_000
REMEMBERED_PAIRS = 400_000
LONGEST_REMEMBERED = 64


@dataclass(frozen=True)
class Vocabulary:
    """The pieces by id, their scores, and the ids of byte pieces by byte. Small and fixed: a model's vocabulary."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    byte_ids: tuple[int, ...]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.vocab_size())
        pieces = tuple(model.id_to_piece(i) for i in size)
        normal = tuple(not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in size)
        byte_ids = tuple(model.piece_to_id(f"<0x{value:02X}>") for value in range(256))
        if not all(model.is_byte(i) for i in byte_ids):
            raise ValueError("the vocabulary has no byte pieces")
        if any(model.is_unused(i) for i in size):
            raise ValueError("vocabularies with unused pieces are not supported")
        if any(SPACE in piece.lstrip(SPACE) for piece, use in zip(pieces, normal, strict=True) if use):
            raise ValueError("a piece holds the space mark after another character")
        return cls(pieces, tuple(model.get_score(i) for i in size), normal, byte_ids)


def marks(pieces: Iterable[str]) -> set[str]:
    """The ASCII characters that are no letters or digits, and all characters that pieces join to them."""
    beside: dict[str, set[str]] = {}
    for piece in pieces:
        for a, b in pairwise(piece):
            if SPACE not in (a, b):
                beside.setdefault(a, set()).add(b)
                beside.setdefault(b, set()).add(a)
    found = {chr(i) for i in range(128) if not chr(i).isalnum()}
    ahead = list(found)
    while ahead:
        new = beside.get(ahead.pop(), set()) - found
        found |= new
        ahead += new
    return found


class Decoder:
    """Decodes with one vocabulary. Much smaller than a codec."""

    def __init__(self, vocabulary: Vocabulary):
        shown = zip(vocabulary.pieces, vocabulary.normal, strict=True)
        self._text: list[str | None] = [piece.replace(SPACE, " ") if use else "" for piece, use in shown]
        self._byte_of = {i: value for value, i in enumerate(vocabulary.byte_ids)}
        for value, i in enumerate(vocabulary.byte_ids):
            self._text[i] = chr(value) if value < 128 else None

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ``ids``. Control ids vanish, and bytes that are no UTF-8 become the replacement character."""
        if not ids:
            return ""
        shown = self._text
        try:
            text = "".join([shown[i] for i in ids])
        except TypeError:  # bytes of longer characters
            text = self._decode_bytes(ids)
        # The mark that encoding puts before a text is dropped again; a space given as a byte is not.
        first = next((i for i in ids if shown[i] != ""), ids[0])
        return text[1:] if first not in self._byte_of and text.startswith(" ") else text

    def _decode_bytes(self, ids: Sequence[int]) -> str:
        parts: list[str] = []
        pending = bytearray()
        for i in ids:
            value = self._byte_of.get(i)
            if value is not None:
                pending.append(value)
                continue
            if pending:
                parts.append(_utf8(pending))
                pending = bytearray()
            parts.append(self._text[i])
        return "".join([*parts, _utf8(pending)])


class Codec(Decoder):
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.vocabulary = vocabulary
        self.id_of = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.normal[i]}
        self.matches = ahocorasick.Automaton()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._chunks: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._characters = {piece for piece in self.id_of if len(piece) == 1}
        inside = "".join(map(re.escape, sorted(marks(self.id_of))))
        self._cut = re.compile(f"{SPACE}*[^{SPACE}{inside}]+|{SPACE}*[{inside}]+|{SPACE}+")
        self._length = [len(piece) for piece in vocabulary.pieces]
        # A piece that merging does not rebuild can never come out.
        usable = {p: i for p, i in self.id_of.items() if len(p) == 1 or self._merge(p) == [p]}
        #: For each piece the longest shorter piece that it begins with, or -1.
        self._shorter = [-1] * len(vocabulary.pieces)
        for piece, i in usable.items():
            if len(piece) > 1:  # a single character is a match wherever it stands
                self.matches.add_word(piece, i)
            prefixes = (usable.get(piece[:length]) for length in range(len(piece) - 1, 0, -1))
            self._shorter[i] = next((p for p in prefixes if p is not None), -1)
        self.matches.make_automaton()

    def _merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by merging. Used for pieces and pairs of pieces, which are short."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else len(parts)
            if left >= 0 and right < len(parts):
                joined = parts[left] + parts[right]
                if (i := self.id_of.get(joined)) is not None:
                    heapq.heappush(queue, (-self.vocabulary.scores[i], left, joined))

        for left in range(len(parts) - 1):
            offer(left)
        while queue:
            _, left, joined = heapq.heappop(queue)
            if parts[left] is None or after[left] >= len(parts) or parts[left] + parts[after[left]] != joined:
                continue
            right = after[left]
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(left)
            offer(before[left])
        return [part for part in parts if part is not None]

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text gives just these two."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= REMEMBERED_PAIRS:
                self._pairs.clear()
            pair = [self.vocabulary.pieces[left], self.vocabulary.pieces[right]]
            known = self._pairs[left, right] = self._merge("".join(pair)) == pair
        return known

    def _walk(self, text: str) -> list[int]:
        """The ids of a text all of whose characters are pieces, by backtracking."""
        size, lengths, shorter, pairs, id_of = len(text), self._length, self._shorter, self._pairs, self.id_of
        # By the position before the start. Ends ascend, so the longest match from a start comes last.
        longest = {end - lengths[i]: i for end, i in self.matches.iter(text)}.get
        failed: bytearray | None = None
        ids: list[int] = []
        at, i, last = 0, longest(-1), -1
        if i is None:
            i = id_of[text[0]]
        while at < size:
            while i >= 0:
                stop = at + lengths[i]
                if failed is None or not failed[stop >> 3] & (1 << (stop & 7)):
                    if last < 0:
                        break
                    fits = pairs.get((last, i))
                    if fits or fits is None and self._fits(last, i):
                        break
                i = shorter[i]
            if i >= 0:
                ids.append(i)
                last, at = i, stop
                if at < size:
                    i = longest(at - 1)
                    if i is None:
                        i = id_of[text[at]]
                continue
            # Merging fixes the piece that ends at a position, so one that leads nowhere fails for good.
            if failed is None:
                failed = bytearray(size // 8 + 1)
            failed[at >> 3] |= 1 << (at & 7)
            if not ids:
                raise AssertionError(f"no encoding for {text!r}")
            tried = ids.pop()
            at -= lengths[tried]
            i, last = shorter[tried], ids[-1] if ids else -1
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a chunk, packed as 32-bit numbers."""
        packed = self._older.get(chunk)
        if packed is None:
            packed = array("i", self._ids(chunk)).tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self._chunks) >= REMEMBERED_CHUNKS // 2:
                self._older, self._chunks = self._chunks, {}
            self._chunks[chunk] = packed
        return packed

    def _ids(self, chunk: str) -> list[int]:
        if self._characters.issuperset(chunk):
            return self._walk(chunk)
        ids: list[int] = []
        start = 0
        for at, character in enumerate(chunk):
            if character not in self.id_of:  # never merges: its bytes
                if start < at:
                    ids.extend(self._walk(chunk[start:at]))
                ids.extend(self.vocabulary.byte_ids[b] for b in character.encode("utf-8", "surrogatepass"))
                start = at + 1
        if start < len(chunk):
            ids.extend(self._walk(chunk[start:]))
        return ids

    def encode_into(self, text: str, out: bytearray) -> None:
        """Append the ids of ``text`` as 32-bit numbers, none for an empty one."""
        if not text:
            return
        for chunk in self._cut.findall(f"{SPACE}{text.replace(' ', SPACE)}"):
            known = self._chunks.get(chunk)
            out += self._chunk(chunk) if known is None else known

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``."""
        out = bytearray()
        self.encode_into(text, out)
        return array("i", bytes(out)).tolist()


def _utf8(data: bytearray) -> str:
    """One replacement character for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for length in (1, 2, 3, 4):
            try:
                out.append(data[at : at + length].decode("utf-8"))
                at += length
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=1)
def _codec(vocabulary: Vocabulary) -> Codec:
    """One codec, with what it remembers, per worker process."""
    return Codec(vocabulary)


@lru_cache(maxsize=1)
def _decoder(vocabulary: Vocabulary) -> Decoder:
    return Decoder(vocabulary)


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text in an array column. A NULL or empty text has none.

    ``model`` is a model file on the driver; its vocabulary (a few hundred kilobytes whatever the data) goes to the tasks.
    Other columns pass unchanged; a column that is called like ``ids`` is replaced. No shuffle.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def make():
        codec = _codec(vocabulary.value)

        def compute(texts: list[str]) -> list[pa.Array]:
            flat, offsets = bytearray(), [0]
            for given in texts:
                codec.encode_into(given, flat)
                offsets.append(len(flat) // 4)
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))]

        return compute

    return add_columns(df, text, make, f"`{ids}` array<int>")


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each id list. NULL lists, and NULLs within lists, count as no ids."""
    from pyspark.sql.types import StringType, StructField, StructType

    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kept = [c for c in df.columns if c != text]

    def run(batches):
        decoder = _decoder(vocabulary.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column(ids)
                if lists.flatten().null_count:
                    given = [[i for i in own or [] if i is not None] for own in lists.to_pylist()]
                else:
                    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                    flat, ends = lists.flatten().to_numpy().tolist(), np.cumsum(sizes).tolist()
                    given = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                texts = [decoder.decode(own) for own in given]
                arrays = [*(part.column(c) for c in kept), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, text])

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in kept), StructField(text, StringType())]))
