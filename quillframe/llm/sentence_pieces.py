"""SentencePiece encoding and decoding: one Aho-Corasick pass and Viterbi.

An automaton over all pieces reports, at each place of a text, the pieces that end there (the
longest, then those on its output links). Each one relaxes the best score at its end, so the best
segmentation is known after a single pass. Scores are the model's piece scores. A character
without a piece of its own becomes byte pieces, at a score below every piece's.

Spaces are written as ``SPACE``, and a text begins with one more. Where no piece of the model has
a ``SPACE`` after another character, the best segmentation of a text is that of its words, each
with the spaces before it; words are then kept in a bounded cache. A ``SPACE`` character of the
text itself becomes bytes, so that decoding gives back every text exactly.

The vocabulary file is read once, by the driver, and travels with the task; nothing is trained.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: How far below the least piece score a character without a piece is.
UNKNOWN_PENALTY = 10.0
#: Words kept by a worker.
CACHED_WORDS = 200_000
#: Rows handled at once.
SLICE_ROWS = 512


class Pieces:
    """Encoder and decoder for the pieces of a SentencePiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(read.get_piece_size())
        texts = [read.id_to_piece(k) for k in ids]
        self.byte_ids = {int(texts[k][3:-1], 16): k for k in ids if read.is_byte(k)}
        usable = [k for k in ids if not (read.is_control(k) or read.is_unknown(k) or read.is_unused(k) or read.is_byte(k))]
        self._build({texts[k]: (k, read.get_score(k)) for k in usable})
        self.unknown_id = read.unk_id()
        self.size = len(texts)

    def _build(self, pieces: dict[str, tuple[int, float]]) -> None:
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for text, (k, score) in pieces.items():
            self.automaton.add_word(text, (len(text), k, score))
        self.automaton.make_automaton()
        self.floor = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.by_word = all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", t) for t in pieces)
        self.back = {k: t.replace(SPACE, " ").encode() for t, (k, _) in pieces.items()} | {
            k: bytes([b]) for b, k in self.byte_ids.items()
        }
        self.cache: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """The ids of the best segmentation of ``text``, in which ``SPACE`` stands for a space.

        Of equally good ones, the longer last piece wins.
        """
        n = len(text)
        score = [0.0] + [-1e300] * n
        back: list[tuple] = [()] * (n + 1)
        unknown = [k for k, c in enumerate(text) if c not in self.pieces]
        todo = 0  # unknown characters before it are considered
        for end, match in self.automaton.iter(text):
            # Places are relaxed from left to right: those before this end come first.
            while todo < len(unknown) and unknown[todo] < end:
                self._pass(unknown[todo], score, back)
                todo += 1
            end += 1
            total = score[end - match[0]] + match[2]
            if total > score[end]:
                score[end] = total
                back[end] = match
        for at in unknown[todo:]:
            self._pass(at, score, back)
        out: list[int] = []
        at = n
        while at:
            size, k, _ = back[at]
            if k < 0:
                out += self._bytes(text[at - 1])[::-1]
            else:
                out.append(k)
            at -= size
        return out[::-1]

    def _pass(self, at: int, score: list[float], back: list[tuple]) -> None:
        """Relaxes the end of the unknown character at ``at``."""
        total = score[at] + self.floor
        if total > score[at + 1]:
            score[at + 1] = total
            back[at + 1] = (1, -1, 0.0)

    def _bytes(self, character: str) -> list[int]:
        return [self.byte_ids.get(b, self.unknown_id) for b in character.encode()]

    def _word(self, word: str) -> bytes:
        """Ids of a word with its spaces before it, as int32 bytes."""
        out: list[int] = []
        for k, part in enumerate(word.split(SPACE)):
            if k:
                out += self._bytes(SPACE)
            if part:
                out += self.best(part.replace(" ", SPACE))
        found = array("i", out).tobytes()
        if len(self.cache) >= CACHED_WORDS:
            self.cache.clear()
        self.cache[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, int32; none for an empty one."""
        if not text:
            return np.zeros(0, np.int32)
        if not self.by_word:
            words = [" " + text]
        elif "  " in text or text[0] == " " or text[-1] == " ":
            words = re.findall(" +[^ ]*", " " + text)
        else:
            words = [" " + w for w in text.split(" ")]
        get = self.cache.get
        return np.frombuffer(b"".join([get(w) or self._word(w) for w in words]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; those without a text (control, unknown) count for nothing."""
        out = b"".join([self.back.get(k, b"") for k in ids.tolist()])
        return out[1:].decode("utf-8", "replace") if out[:1] == b" " else out.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(model: bytes) -> Pieces:
    """The pieces of a model file's bytes, once a worker."""
    return Pieces(model)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE, keep: list[str] | None = None
) -> DataFrame:
    """For each row: ``id_col``, the columns named in ``keep``, ids (array of int), n_tokens,
    n_byte_tokens, ids_sha256 (of the ids as little-endian int32) and round_trip (whether decoding
    the ids gives the text).

    A null text has null ids and hash, no tokens and a true round trip; an empty text has no
    tokens. Repeated rows stay; other columns are left out; an empty table gives an empty one.
    """
    model = Path(model_file).read_bytes()
    columns = [id_col, *(keep or [])]
    added = T._parse_datatype_string("ids array<int>, n_tokens long, n_byte_tokens long, ids_sha256 string, round_trip boolean")
    schema = T.StructType([*docs.select(*columns).schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        is_byte = np.zeros(pieces.size, bool)
        is_byte[list(pieces.byte_ids.values())] = True
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column(len(columns)).to_pylist()
                ids = [None if t is None else pieces.encode(t) for t in texts]
                sizes = np.array([0 if x is None else len(x) for x in ids])
                offsets = pa.array(
                    [None if x is None else int(o) for x, o in zip(ids, np.cumsum(sizes) - sizes, strict=True)] + [int(sizes.sum())], pa.int32()
                )
                flat = np.concatenate([np.zeros(0, np.int32), *(x for x in ids if x is not None)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(k) for k in range(len(columns))),
                        pa.ListArray.from_arrays(offsets, pa.array(flat)),
                        pa.array(sizes, pa.int64()),
                        pa.array([0 if x is None else int(is_byte[x].sum()) for x in ids], pa.int64()),
                        pa.array([None if x is None else hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], pa.string()),
                        pa.array([x is None or pieces.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.select(*columns, F.col(text_col).cast("string").alias("text encoded")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``encoded`` with a column ``text_col``: the text of ``ids_col`` (null for null ids). A
    column of that name is replaced."""
    model = Path(model_file).read_bytes()
    rest = [c for c in encoded.columns if c != text_col]
    schema = T.StructType([*encoded.select(*rest).schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            ids = batch.column(len(rest))
            out = [None if x is None else pieces.decode(np.array(x, np.int32)) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(rest))), pa.array(out, pa.string())], names=schema.names)

    return encoded.select(*rest, F.col(ids_col).alias("ids decoded")).mapInArrow(run, schema)
