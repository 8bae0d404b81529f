"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a one-pass Viterbi."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pulsegrid.llm.common import Cache, slices, texts_of

SPACE = "\u2581"
CACHED_WORDS = 400_000


class PackedWords(Cache):
    """Packed ids by word; a word that is not there yet is solved when it is looked up."""

    def __init__(self, solve: Callable[[str], list[int]]):
        super().__init__(CACHED_WORDS)
        self.solve = solve

    def __missing__(self, word: str) -> bytes:
        self[word] = packed = np.array(self.solve(word), "<u4").tobytes()
        return packed


class PieceCodec:
    """Best-scoring segmentation of a text into the pieces of a model.

    Text becomes pieces as the model's own rules say: a mark is put in front, spaces become marks. The score
    of a segmentation is the sum of its pieces' scores; of equal ones the last piece is the longest. A
    character that no piece covers becomes its UTF-8 bytes, at a score below that of any piece. Pieces of
    this kind of model never run from a word into the mark of the next, which is checked when the model is
    read; words can then be solved one by one and kept in a bounded cache.
    """

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [
            i for i, p in enumerate(pieces) if p and not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece runs into the next word")
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(pieces[i], (len(pieces[i]), model.get_score(i), i))
        self.automaton.make_automaton()
        self.single = {pieces[i] for i in plain if len(pieces[i]) == 1}
        self.floor = min(model.get_score(i) for i in plain) * 2 - 10
        self.bytes = [next((i for i, p in enumerate(pieces) if p == f"<0x{b:02X}>" and model.is_byte(i)), model.unk_id()) for b in range(256)]
        self.first_byte_ids = {i: b for b, i in enumerate(self.bytes) if i != model.unk_id()}
        self.decoded = {i: pieces[i].replace(SPACE, " ").encode() for i in plain}
        self.decoded |= {i: bytes([b]) for i, b in self.first_byte_ids.items()}
        self.words = PackedWords(self.viterbi)
        self.split = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def viterbi(self, word: str) -> list[int]:
        n = len(word)
        best, back = [0.0] + [None] * n, [(0, -1)] * (n + 1)
        at = 0  # positions up to here are final but for pieces that end there

        def cover(upto: int) -> None:
            nonlocal at
            while at < upto:
                score = best[at] + self.floor * len(word[at].encode("utf-8", "surrogatepass"))
                if word[at] not in self.single and (best[at + 1] is None or score > best[at + 1]):
                    best[at + 1], back[at + 1] = score, (at, -1)
                at += 1

        for end, (length, score, i) in self.automaton.iter(word):  # all pieces that end here, by output links
            cover(end)
            start = end + 1 - length
            total = best[start] + score
            if best[end + 1] is None or total > best[end + 1] or (total == best[end + 1] and start < back[end + 1][0]):
                best[end + 1], back[end + 1] = total, (start, i)
        cover(n)
        out, end = [], n
        while end:
            start, i = back[end]
            if i < 0:
                out.extend(self.bytes[b] for b in reversed(word[start:end].encode("utf-8", "surrogatepass")))
            else:
                out.append(i)
            end = start
        return out[::-1]

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        out = b"".join(map(self.words.__getitem__, self.split(SPACE + text.replace(" ", SPACE))))
        self.words.trim()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of `ids`; unknown ids stand for nothing, bytes that are no UTF-8 for the replacement character."""
        get = self.decoded.get
        text = b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_pieces(docs: DataFrame, model_file: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the column `ids` (array of int), replaced if it exists; null and empty texts have no ids."""
    docs = docs.drop(ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            for part in slices(batch, text, 4_000_000):
                flat = [np.frombuffer(own.packed(t), "<u4").astype(np.int32) for t in texts_of(part, text)]
                offsets = pa.array(np.cumsum([0, *map(len, flat)]), pa.int32())
                values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32), pa.int32())
                yield part.append_column(ids, pa.ListArray.from_arrays(offsets, values))

    return docs.mapInArrow(run, schema)


def decode_pieces(docs: DataFrame, model_file: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the column `text` made from `ids`, replaced if it exists; null ids give an empty text."""
    docs = docs.drop(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            yield batch.append_column(text, pa.array([own.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string()))

    return docs.mapInArrow(run, schema)


def piece_digest(docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `key`, n_ids, n_byte_ids, ids_sha256 (little-endian unsigned 32-bit ids) and round_trip.

    Encodes and decodes every whole text without letting ids leave the task; round_trip says whether decoding
    gives the text back. Null texts count as empty.
    """
    schema = docs.select(key).schema.add("n_ids", "long").add("n_byte_ids", "long").add("ids_sha256", "string").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        as_byte = np.zeros(1 + max([*own.decoded, *own.bytes]), bool)
        as_byte[list(own.first_byte_ids)] = True
        for batch in batches:
            rows = []
            for t in texts_of(batch, text):
                packed = own.packed(t)
                ids = np.frombuffer(packed, "<u4")
                rows.append((len(ids), int(as_byte[ids].sum()), hashlib.sha256(packed).hexdigest(), own.decode(ids.tolist()) == t))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            arrays = [batch.column(key), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, [key, "n_ids", "n_byte_ids", "ids_sha256", "round_trip"])

    return docs.select(key, text).mapInArrow(run, schema)
