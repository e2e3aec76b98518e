"""SentencePiece BPE: a table of each prefix's last token, and the way back to text.

A merge encoding has one useful property: the encoding of a prefix of the text ends in
exactly one token, and two neighbours stay apart in the encoding of the whole text if and
only if they stay apart when their own two strings are encoded alone. So an automaton lists
the vocabulary entries that end at each position, the entry whose left neighbour (the last
token of the prefix before it) is compatible is the one to keep, and the ids are read from
the table backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BoundedCache, file_bytes, prepare, released

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Entries that a worker keeps: chunks of text, and tested pairs.
CHUNKS, PAIRS = 1_000_000, 1_000_000
#: The same for a worker that is to forget them when its task ends.
FEW_CHUNKS, FEW_PAIRS = 600_000, 200_000

#: Fixed values of the format: the escaped space, what an unknown id decodes to, and the
#: replacement of a byte that is no UTF-8.
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
REPLACEMENT = "�"

#: Stands for a control token until all is decoded: it is no text, but bytes do not join across it.
_NOTHING = "\ud800"
_RAW_BYTES = re.compile("[\udc80-\udcff]+")


class PieceModel:
    """The vocabulary of a SentencePiece BPE model with byte fallback, and no normalization."""

    def __init__(self, data: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=data)
        size = library.get_piece_size()
        probe = "ﬁ Á　 \t x  "
        if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models without normalization, with a space put before the text")
        self.end = library.eos_id()
        self.text: list[str] = []
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.marked = bytearray(size)
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_control(i):
                self.text.append(_NOTHING)
            elif library.is_unknown(i):
                self.text.append(UNKNOWN_TEXT)
            elif library.is_byte(i):
                byte = int(piece[3:5], 16)
                self.bytes[byte] = i
                self.text.append(chr(byte) if byte < 128 else chr(0xDC00 + byte))
            else:
                self.text.append(piece.replace(SPACE, " "))
                self.marked[i] = piece.startswith(SPACE)
                self.ids[piece] = i
                self.score[piece] = library.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans words")
        self.alone = {p for p in self.ids if self._merged(p) == [p]}
        self.matches = ahocorasick.Automaton()
        for piece in self.alone:
            self.matches.add_word(piece, (self.ids[piece], len(piece), piece))
        self.matches.make_automaton()
        self.decoded = {str(i): text for i, text in enumerate(self.text)}
        self.apart = BoundedCache(self._apart, PAIRS)
        self.chunk = BoundedCache(self._chunk, CHUNKS)
        newline = "\n" if all("\n" not in p for p in self.ids) else ""
        self._cut = re.compile(rf" *[^ {newline}]+|{newline or '(?!)'}| +").findall

    def forget(self) -> None:
        """Empty the caches: a worker keeps the model for later tasks, but not what it has seen.

        That costs time, and is for sessions where other Python stages need the memory.
        """
        for cache in (self.apart, self.chunk):
            cache.clear()
            cache.before = {}

    def _merged(self, text: str) -> list[str]:
        """Of a string of one or two tokens: join the best pair, the leftmost of equals, until none is left."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, pair: tuple[str, str]) -> bool:
        """Whether two neighbouring tokens stay as they are when encoded together."""
        return self._merged(pair[0] + pair[1]) == [*pair]

    def _chunk(self, chunk: str) -> str:
        """Ids of a piece of text that no token leaves, in decimal, a space behind each."""
        text = chunk.replace(" ", SPACE)
        last: list[str | None] = [None] * (len(text) + 1)
        apart = self.apart
        for at, (_, size, piece) in self.matches.iter(text):
            if last[at + 1] is None:
                start = at + 1 - size
                before = last[start]
                if before is None and start and text[start - 1] in self.score:
                    continue
                if before is None or apart[before, piece]:
                    last[at + 1] = piece
        found: list[int] = []
        at = len(text)
        while at:
            piece = last[at]
            if piece is None:
                at -= 1
                found.extend(self.bytes[b] for b in reversed(text[at].encode()))
            else:
                at -= len(piece)
                found.append(self.ids[piece])
        return "".join([f"{i} " for i in reversed(found)])

    def encode(self, text: str | None) -> str:
        """Ids in decimal, a space between them, with the end id last."""
        if not text:
            return str(self.end)
        chunks = self._cut(" " + text.replace(SPACE, " "))
        return "".join(map(self.chunk.__getitem__, chunks)) + str(self.end)

    def decode(self, ids: str) -> str:
        """Text of ids in decimal: runs of byte ids become characters, a byte that is no UTF-8 a replacement."""
        each = ids.split()
        text = "".join(map(self.decoded.__getitem__, each))
        if not text.isascii():
            text = _RAW_BYTES.sub(_characters, text).replace(_NOTHING, "")
        first = next((i for i in each if self.decoded[i] != _NOTHING), None)
        return text[1:] if first is not None and self.marked[int(first)] else text


def _characters(run: re.Match[str]) -> str:
    data, out, at = run[0].encode("utf-8", "surrogateescape"), [], 0
    while at < len(data):
        for size in (2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append(REPLACEMENT)
            at += 1
    return "".join(out)


_MODELS: dict[int, PieceModel] = {}


def worker_model(data: Broadcast) -> PieceModel:
    """One model for each worker, which lives as long as the worker does."""
    key = hash(data.value)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(data.value)
    return _MODELS[key]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_column(df: DataFrame, text: str | Column, model_path: str = MODEL) -> Column:
    """Array of ids with the end id, for a text column of ``df``. Null and empty: the end id alone."""
    prepare(df.sparkSession)
    data = file_bytes(df.sparkSession, model_path)

    @F.arrow_udf("array<int>")
    @released
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_model(data)
        for texts in batches:
            yield pa.array([[int(i) for i in model.encode(t).split()] for t in texts.to_pylist()], pa.list_(pa.int32()))

    return encode(text)


def decode_column(df: DataFrame, ids: str | Column, model_path: str = MODEL) -> Column:
    """Text of an array of ids. A null array gives null, an empty one the empty text."""
    prepare(df.sparkSession)
    data = file_bytes(df.sparkSession, model_path)

    @F.arrow_udf("string")
    @released
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_model(data)
        for lists in batches:
            yield pa.array([None if x is None else model.decode(" ".join(map(str, x))) for x in lists.to_pylist()], pa.string())

    return decode(ids)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, forget: bool = False) -> DataFrame:
    """Encode and decode each text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A row comes out for each row that goes in, whatever its id. A null text counts as empty,
    which encodes to the end id alone. Other columns of ``df``, whatever their names, are left out.
    No shuffle; a worker holds one batch and its bounded caches, beyond the task unless it is to ``forget``.
    """
    prepare(df.sparkSession)
    data = file_bytes(df.sparkSession, model_path)

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    @released
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_model(data)
        model.chunk.limit, model.apart.limit = (FEW_CHUNKS, FEW_PAIRS) if forget else (CHUNKS, PAIRS)
        for texts in batches:
            counts, ids_digests, text_digests = [], [], []
            for value in texts:
                ids = model.encode(value.as_py())
                counts.append(ids.count(" ") + 1)
                ids_digests.append(_digest(ids))
                text_digests.append(_digest(model.decode(ids)))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )
        if forget:
            model.forget()

    found = df.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col)).alias("found"))
    return found.select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256")
