"""SentencePiece-compatible BPE: encoding by backtracking, and decoding.

For a merge-type vocabulary a sequence of pieces is the encoding of its text
exactly if every two neighbours stay apart when their joined text is merged
anew. So the encoder walks over a text and takes the longest piece that fits
its predecessor (Aho-Corasick gives all pieces at all places at once, the
re-merging of two pieces is remembered per pair); where none fits it steps back,
and a bit field remembers the places from which nothing led on.

A text is first cut where no piece can reach across: before word marks if pieces
hold them only at their start, at line ends if no piece has one, and between
letters and anything else if no piece mixes them. Which of these hold is read
from the vocabulary. Encodings of cuts are remembered.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Cuts and pairs remembered by one worker; then it starts anew.
REMEMBERED = 250_000


class Remembered(dict):
    """A bounded memory of a function's values: what was in use lately stays."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


class PieceCodec:
    """Encodes and decodes as the sentencepiece library does with the same model
    (BPE with byte fallback, dummy prefix, no normalisation)."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        self.unk_surface = model.decode([self.unk])
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in special if model.is_byte(i)}
        self.rank = {p: (-model.get_score(i), i) for i, p in enumerate(self.pieces) if i not in special}
        self.found = ahocorasick.Automaton()
        for piece in self.rank:
            if len(piece) == 1 or self.merged(piece) == [piece]:
                self.found.add_word(piece, piece)
        self.found.make_automaton()
        self.cut = self._cuts()
        self.apart = Remembered(lambda pair: self.merged(pair[0] + pair[1]) == [*pair])
        self.encoded = Remembered(self._packed)
        byte_at = {i: b for b, i in self.bytes.items()}
        self.surface = [
            bytes([byte_at[i]]) if i in byte_at else self.unk_surface.encode() if i == self.unk else b"" if i in special else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.is_byte = np.isin(np.arange(size), list(byte_at))
        self.marked = np.array([i not in special and p.startswith(MARK) for i, p in enumerate(self.pieces)])
        self.silent = np.array([i in special and i not in byte_at and i != self.unk for i in range(size)])

    def _cuts(self) -> re.Pattern:
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            return re.compile("(?s).+")
        end = "" if any("\n" in p for p in self.rank) else "\n"
        # Letters that a piece joins to other characters count as such characters.
        others = ""
        while True:
            letter = re.compile(rf"[^\W\d_{others}]")
            mixed = [p for p in self.rank if len({letter.match(c) is None for c in p.lstrip(MARK)}) > 1]
            more = {c for p in mixed for c in p if letter.match(c)}
            if not more or len(others) + len(more) > 50:
                break
            others += "".join(sorted(more))
        if mixed:
            body = [f"{MARK}*[^{MARK}{end}]+"]
        else:
            body = [f"{MARK}*{letter.pattern}+", rf"{MARK}*(?:[^\w{MARK}{end}]|[\d_{others}])+"]
        return re.compile("|".join([*body, *([end] * bool(end)), f"{MARK}+"]))

    def merged(self, text: str) -> list[str]:
        """Merge a short text from its characters: best piece first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank and (best is None or rank[0] < best):
                    best, at = rank[0], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, text: str) -> list[str]:
        """The pieces of one cut, in order; a character outside of all pieces stands for itself."""
        if text in self.found:
            return [text]
        starts: list[list[str]] = [[x] for x in text]
        for end, piece in self.found.iter(text):
            if (size := len(piece)) > 1:
                starts[end + 1 - size].append(piece)
        apart, size, failed, at = self.apart, len(text), 0, 0
        pieces, choices = [""], [0]
        options = starts[0]
        choice = len(options) - 1
        while True:
            last = pieces[-1]
            while choice >= 0:
                piece = options[choice]
                if not failed >> (at + len(piece)) & 1 and (not last or apart[last, piece]):
                    break
                choice -= 1
            if choice >= 0:
                pieces.append(piece)
                choices.append(choice)
                at += len(piece)
                if at == size:
                    return pieces[1:]
                options = starts[at]
                choice = len(options) - 1
            else:
                failed |= 1 << at
                if not last:
                    raise ValueError("a vocabulary that has no merges for a text")
                at -= len(pieces.pop())
                options = starts[at]
                choice = choices.pop() - 1

    def _packed(self, cut: str) -> bytes:
        ids: list[int] = []
        for piece in self.split(cut):
            if piece in self.rank:
                ids.append(self.rank[piece][1])
            else:
                ids += [self.bytes[b] if self.bytes else self.unk for b in piece.encode("utf-8", "surrogatepass")]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids with begin and end; null and the empty text have only these."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        body = b"".join(map(self.encoded.__getitem__, self.cut.findall(marked)))
        return np.concatenate([[self.bos], np.frombuffer(body, dtype="<u4"), [self.eos]]).astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        silent = self.silent[ids]
        spoken = ids[~silent]
        if silent[1:-1].any():
            return self._decode_apart(ids)
        raw = b"".join(map(self.surface.__getitem__, spoken.tolist()))
        if len(spoken) and self.marked[spoken[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_apart(ids)

    def _decode_apart(self, ids: np.ndarray) -> str:
        """Each run of byte pieces is read by itself, with a replacement for each broken byte."""
        out: list[str] = []
        run = b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                run = run[size:]
            if i is not None:
                out.append(self.surface[i].decode())
        text = "".join(out)
        spoken = ids[~self.silent[ids]]
        return text[1:] if len(spoken) and self.marked[spoken[0]] else text


@functools.cache
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_column(text: Column, model_file: str) -> Column:
    """array<int> of the ids, with begin and end."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(model_file)
        return pa.array([own.encode(t).astype(np.int32) for t in texts.to_pylist()], type=pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, model_file: str) -> Column:
    """Text of array<int> ids; null for null."""

    @F.arrow_udf(T.StringType())
    def decode(rows: pa.Array) -> pa.Array:
        own = codec(model_file)
        return pa.array([None if r is None else own.decode(np.array(r, dtype=np.int64)) for r in rows.to_pylist()], type=pa.string())

    return decode(ids)


_DIGESTS = T.StructType().add("n_tokens", T.LongType()).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
_DIGEST_TYPE = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's number of ids, the digest of its ids, and that of the text decoded from them.

    The ids stay inside the task, so only digests move. Null is an empty text; rows
    that repeat give as many rows; an empty table gives none; other columns are not read.
    """

    def digests(texts: Iterable[str | None]) -> list[dict]:
        own, out = codec(model_file), []
        for text in texts:
            ids = own.encode(text)
            out.append(
                {
                    "n_tokens": len(ids),
                    "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(own.decode(ids).encode("utf-8", "surrogatepass")).hexdigest(),
                }
            )
        return out

    @F.arrow_udf(_DIGESTS)
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array(digests(texts.to_pylist()), type=_DIGEST_TYPE)

    return docs.select(F.col(id_col), digest(F.col(text_col)).alias("d")).select(id_col, "d.*")
