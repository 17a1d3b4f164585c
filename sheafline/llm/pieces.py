"""Encoding to and decoding from the ids of a SentencePiece merge (BPE) model, exactly as its library does.

A model of merge type begins with single characters and again and again joins the best scored pair of neighbours whose
joined text is a piece, the leftmost of equals. Both sides of a boundary that survives were built without looking
across it, so for every prefix of a text the last piece of its encoding is unique, whatever follows, and a list of
pieces is an encoding if and only if every two neighbours are the encoding of their joined text. So:

* an automaton over all pieces lists, for every place, the pieces that end there;
* the one among them that is compatible with the last piece of the prefix before it is stored in a table;
* the ids are read off the table from the end of the text backwards.

That is linear in the text, also in one without spaces. Compatibility is tested by merging the joined text of two
pieces, once per pair while it is remembered. Texts are cut where no piece reaches across: before a space mark that
follows another character, and around line breaks and other control characters that no piece holds. Encodings of
short parts are remembered, at most MEMORY of them.

Preparation is that of the model kind with identity normalization: a space in front of a text that is not empty, spaces
written as the mark U+2581, nothing else changed. A character in no piece becomes the pieces of its UTF-8 bytes (the
unknown id where the model has none). Null and empty texts have no ids. Every row is encoded by itself, so repeated rows,
empty tables and columns of any other name need no care. Rows go in batches of about BATCH ids; one text is never cut.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passing import quoted, with_text

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
MEMORY = 1 << 18  # remembered parts, and about as many remembered pairs
SHORT = 32  # characters of a part worth remembering
BATCH = 1 << 20


class Pieces:
    """The tables of one model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.texts = [model.id_to_piece(i) for i in ids]
        self.unknown = model.unk_id()
        self.bytes = {int(self.texts[i][3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.hidden = {i for i in ids if model.is_control(i) or model.is_unknown(i)}
        plain = [i for i in ids if i not in self.byte_of and i not in self.hidden]
        self.id = {self.texts[i]: i for i in plain}
        self.score = {self.texts[i]: model.get_score(i) for i in plain}
        held = {c for t in self.id for c in t}
        self.automaton = ahocorasick.Automaton()
        for text in self.id:
            if len(text) == 1 or self.merge(text) == [text]:  # others never come out of merging
                self.automaton.add_word(text, (len(text), text, {}))
        self.automaton.make_automaton()
        breaks = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in held)
        runs = any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.id)
        mark = "" if runs else f"{SPACE}+[^{SPACE}{breaks}]*|"
        self.part = re.compile(f"{mark}[^{'' if runs else SPACE}{breaks}]+|[{breaks}]+" if breaks or not runs else "(?s).+")
        self.pairs = 0  # remembered pairs, each with its right piece
        self.parts: dict[str, array] = {}
        self.backs: dict[int, str] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by the definition: join the best pair until none is left."""
        now, score = list(text), self.score
        while len(now) > 1:
            best, at = None, -1
            for i in range(len(now) - 1):
                s = score.get(now[i] + now[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            now[at:at + 2] = [now[at] + now[at + 1]]
        return now

    def compatible(self, left: str, right: str) -> bool:
        return left + right not in self.id and self.merge(left + right) == [left, right]

    def split(self, text: str) -> list[str]:
        """The pieces of a text of any length, by the table of last pieces."""
        last = list(text)  # a character alone, piece or not, where nothing longer fits
        done = -1
        for end, (size, piece, lefts) in self.automaton.iter(text):  # the longest first
            if end == done or size == 1:
                continue
            if size <= end:
                before = last[end - size]
                fits = lefts.get(before)
                if fits is None:
                    fits = lefts[before] = self.compatible(before, piece)
                    self.pairs += 1
                if not fits:
                    continue
            last[end] = piece
            done = end
        if self.pairs >= MEMORY:
            for _, _, lefts in self.automaton.values():
                lefts.clear()
            self.pairs = 0
        out, at = [], len(text)
        while at:
            piece = last[at - 1]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    def numbers(self, text: str) -> array:
        out, known = array("i"), self.id
        for piece in self.split(text):
            if piece in known:
                out.append(known[piece])
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str | None) -> array:
        out = array("i")
        if not text:
            return out
        parts = self.parts
        for part in self.part.findall(SPACE + text.replace(" ", SPACE)):
            ids = parts.get(part)
            if ids is None:
                ids = self.numbers(part)
                if len(part) <= SHORT:
                    if len(parts) >= MEMORY:
                        parts.clear()
                    parts[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of some ids: the space in front goes; bytes that are no UTF-8 become U+FFFD each."""
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.hidden:
                out.append(self.texts[i])
        if run:
            out.append(characters(bytes(run)))
        if out and out[0].startswith(SPACE):
            out[0] = out[0][1:]
        return "".join(out).replace(SPACE, " ")


def characters(data: bytes) -> str:
    """UTF-8 to text, each byte that belongs to no character as one U+FFFD."""
    return data.decode("utf-8", errors="surrogateescape").translate(_LONE)


_LONE = {0xDC00 + b: "�" for b in range(128, 256)}
_kept: dict[str, Pieces] = {}


def pieces(path: str = MODEL) -> Pieces:
    """The tables of a model, made once per worker process."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = Pieces(path)
    return _kept[path]


def _encode(path: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pieces(path)
        for batch in batches:
            done, bounds, ids = 0, [0], array("i")
            for i, text in enumerate(batch.column(at), 1):
                ids += tables.encode(text.as_py())
                bounds.append(len(ids))
                if len(ids) >= BATCH or i == batch.num_rows:
                    values = pa.array(np.frombuffer(ids, np.int32) if ids else [], pa.int32())
                    found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([*(c.slice(done, i - done) for c in batch.columns), found],
                                                     names=[*batch.schema.names, "__ids"])
                    done, bounds, ids = i, [0], array("i")

    return run


def _decode(path: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pieces(path)
        for batch in batches:
            texts, size, done = [], 0, 0
            for i, row in enumerate(batch.column(at), 1):
                ids = row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else None
                texts.append(None if ids is None else tables.decode(ids))
                size += len(ids or ())
                if size >= BATCH or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*(c.slice(done, i - done) for c in batch.columns), pa.array(texts, pa.string())],
                                                     names=[*batch.schema.names, "__decoded"])
                    texts, size, done = [], 0, i

    return run


def encode(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Columns `keep`, then `ids`: the ids of the text, ARRAY<INT>, empty for null and empty texts."""
    out, at, kept = with_text(rows, keep, text)
    kinds = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in out.schema.fields)
    done = out.mapInArrow(_encode(model, at), f"{kinds}, __ids ARRAY<INT>")
    return done.select(*map(quoted, keep), F.col("__ids").alias(ids))


def decode(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """Columns `keep`, then `text`: what the ids stand for; null where they are null. Ids outside the model fail."""
    out, at, _ = with_text(rows, keep, ids)
    kinds = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in out.schema.fields)
    done = out.mapInArrow(_decode(model, at), f"{kinds}, __decoded STRING")
    return done.select(*map(quoted, keep), F.col("__decoded").alias(text))
