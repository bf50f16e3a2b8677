"""SentencePiece encoding and decoding by weighted finite-state transduction.

Four machines are compiled from a model file: a normaliser (characters to normal characters, white space to its
mark), the pieces (a trie that reads characters and writes a piece), byte fallback (any character to its bytes, at
a cost that only pays where no piece will do), and an acceptor of piece sequences. They are composed lazily with each
input; its encoding is the shortest path in the tropical semiring (costs add, the least wins).

The model is a merge (BPE) one. Its pieces are free and the acceptor decides: two pieces may follow each other only
if merging the text of both, by the model's order, gives those two pieces (other sequences cost infinity). A sequence
whose neighbours all agree is the one that merging yields, so exactly one path has finite cost. Nothing is trained here.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.llm.common import fresh, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Mark of white space in pieces.
MARK = "▁"
#: Shown by the reference decoder for an unknown piece.
UNKNOWN_SURFACE = " ⁇ "
#: Paths of words and agreements of pieces that a task remembers.
WORDS_KEPT, PAIRS_KEPT = 300_000, 300_000
#: Words above this length are worked out each time.
LONG_WORD = 64

# Kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield tag >> 3, data[at:at + size]
            at += size


class Model:
    """What a model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        kind, charsmap = 1, b""
        self.dummy_prefix = self.trim = self.mark_spaces = True
        for field, value in _fields(data):
            if field == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                self.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif field == 2:
                own = dict(_fields(value))
                kind = own.get(3, 1)
            elif field == 3:
                own = dict(_fields(value))
                charsmap = own.get(2, b"")
                self.dummy_prefix, self.trim, self.mark_spaces = (bool(own.get(n, 1)) for n in (3, 4, 5))
        if charsmap or self.trim or not self.mark_spaces:
            raise ValueError("only models that leave characters as they are and mark spaces are supported")
        if kind != BPE or any(k == USER for _, _, k in self.pieces):
            raise ValueError("only merge models without user-defined pieces are supported")


class Transducer:
    """The compiled machines and their composition with inputs."""

    def __init__(self, model: Model):
        self.model = model
        self.ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind in (NORMAL, UNUSED)}
        self.bytes = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), 0)
        self.score = [score for _, score, _ in model.pieces]
        usable = [(text, i) for text, i in self.ids.items() if model.pieces[i][2] == NORMAL]
        #: the piece machine: a state is a dict of next states by character; the end of a piece is under ""
        self.trie: dict = {}
        for text, i in usable:
            state = self.trie
            for ch in text:
                state = state.setdefault(ch, {})
            state[""] = i
        self.cut = self._cutter([text for text, _ in usable])
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple[tuple[str, float, float], ...] | None] = {}
        self.controls = {i for i, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}
        self.written = [self._write(text, kind) for text, _, kind in model.pieces]
        self.sizes = np.array([len(x) for x in self.written], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes_of_all = np.frombuffer(b"".join(self.written), np.uint8)

    @staticmethod
    def _cutter(texts: list[str]) -> Callable[[str], list[str]]:
        """Cuts a text where no piece can lie across, before marks and around line feeds; the parts' paths are independent.

        If a piece does lie across such a place, a text is one part.
        """
        if any(MARK in text.lstrip(MARK) or "\n" in text for text in texts):
            return lambda text: [text] if text else []
        return re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall

    @staticmethod
    def _write(text: str, kind: int) -> bytes:
        """What the inverse machine writes for a piece."""
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        if kind in (CONTROL, UNKNOWN):
            return b"" if kind == CONTROL else utf8(UNKNOWN_SURFACE)
        return utf8(text.replace(MARK, " "))

    def normalise(self, text: str) -> str:
        """The normaliser's output: identity on characters, spaces marked, a mark in front."""
        text = text.replace(" ", MARK)
        return MARK + text if text and self.model.dummy_prefix else text

    def merged(self, text: str, stop: int = 0) -> list[int]:
        """Pieces of a short text by merging neighbours, best score first, leftmost on ties; characters without a piece are -1.

        Before a merge to `stop` characters it ends.
        """
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        queue: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (i := self.ids.get(parts[a] + parts[b])) is not None:
                heapq.heappush(queue, (-self.score[i], a, parts[a] + parts[b]))

        for a in range(len(parts) - 1):
            offer(a, a + 1)
        while queue:
            _, a, whole = heapq.heappop(queue)
            b = right[a]
            if parts[a] is None or b < 0 or parts[a] + parts[b] != whole:
                continue
            if len(whole) == stop:
                break
            parts[a], parts[b], right[a] = whole, None, right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [self.ids.get(x, -1) for x in parts if x is not None]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merging completes a piece; None for a character, or a piece that merging never yields."""
        last = [self.model.pieces[i][0] if i >= 0 else "" for i in self.merged(piece, stop=len(piece))] if len(piece) > 1 else []
        return (last[0], last[1]) if len(last) == 2 and piece in self.ids else None

    def edge(self, piece: int, right: bool) -> tuple[tuple[str, float, float], ...] | None:
        """Parts that stood at one end of a piece while it was merged, the whole first: (part, when it came, when it went).

        Merges are dated by their piece's cost, since the best score is merged first. None if merging never yields the piece.
        """
        key = piece * 2 + right
        if key not in self.edges:
            text, out, gone = self.model.pieces[piece][0], [], float("inf")
            while text:
                parts = self.halves(text)
                if parts is None and len(text) > 1:
                    out = None
                    break
                came = -self.score[self.ids[text]] if parts else 0.0
                out.append((sys.intern(text), came, gone))
                text, gone = (parts[1] if right else parts[0]) if parts else "", came
            self.edges[key] = out if out is None else tuple(out)
        return self.edges[key]

    def agree(self, a: int, b: int) -> bool:
        """The acceptor: whether piece b may follow piece a (-1: nothing, or a fallback).

        It may unless two parts that met at the border at some time would have been merged before either went
        into a larger part of its own piece. Later merges are undone first.
        """
        key = (a << 20) + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            found = self.pairs[key] = self._agree(a, b)
        return found

    def _agree(self, a: int, b: int) -> bool:
        after = self.edge(b, False)
        if a < 0 or after is None:
            return after is not None
        before = self.edge(a, True)
        if before is None:
            return False
        i = j = 0
        while True:
            (x, x_came, x_gone), (y, y_came, y_gone) = before[i], after[j]
            across = self.ids.get(x + y)
            if across is not None and -self.score[across] < x_gone and -self.score[across] <= y_gone:
                return False
            if j + 1 < len(after) and (y_came >= x_came or i + 1 == len(before)):
                j += 1
            elif i + 1 < len(before):
                i += 1
            else:
                return True

    def shortest(self, text: str) -> list[int]:
        """The best path through text o pieces o fallback o acceptor.

        A state is (place, last piece), -1 after a fallback arc. Fallback is needed exactly where no piece starts,
        and the rest of a path is free or impossible: the first path found to the end is the shortest. The search
        goes depth first, longest piece first, and enters no state twice.
        """
        size, at, last = len(text), 0, -1
        path: list[tuple[int, int, list[tuple[int, int]]]] = []
        dead: set[tuple[int, int]] = set()
        trie, pairs, agree = self.trie, self.pairs, self.agree
        while at < size:
            arcs: list[tuple[int, int]] = []
            state, end = trie, at
            while end < size and (state := state.get(text[end])) is not None:
                end += 1
                if (piece := state.get("")) is not None:
                    arcs.append((end, piece))
            if not arcs or arcs[0][0] > at + 1:
                arcs.append((at + 1, -1))
            while True:
                while arcs:
                    end, piece = arcs.pop()
                    if piece >= 0:
                        fits = pairs.get((last << 20) + piece)
                        if fits is None:
                            fits = agree(last, piece)
                        if not fits:
                            continue
                    if not dead or (end, piece) not in dead:
                        break
                else:
                    dead.add((at, last))
                    if not path:
                        raise ValueError("no path of finite cost")
                    at, last, arcs = path.pop()
                    continue
                path.append((at, last, arcs))
                at, last = end, piece
                break
        out: list[int] = []
        for (start, _, _), piece in zip(path, [*[p for _, p, _ in path[1:]], last]):
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.fallback(text[start]))
        return out

    def fallback(self, ch: str) -> list[int]:
        """A character without a piece: its bytes, or the unknown piece in a model without them."""
        return [self.bytes[b] for b in utf8(ch)] if len(self.bytes) == 256 else [self.unknown]

    def word(self, text: str) -> tuple[int, ...]:
        """Path of a word that begins with any number of marks and has none further on.

        Pieces of marks only score alike, so that places decide their order: they are merged as such, with
        the last mark left to the word if the word takes it.
        """
        core = text.lstrip(MARK)
        marks = len(text) - len(core)
        if not core:
            found = tuple(self.merged(text))
        elif marks > 1:
            path = self.shortest(MARK + core)
            alone = path[0] == self.ids.get(MARK)
            found = (*self.merged(MARK * (marks if alone else marks - 1)), *path[alone:])
        else:
            found = tuple(self.shortest(text))
        if len(text) <= LONG_WORD:
            if len(self.words) >= WORDS_KEPT:
                self.words.clear()
            self.words[text] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        """Piece numbers of a text; none for a null or empty one."""
        out: list[int] = []
        known = self.words
        for part in self.cut(self.normalise(text or "")):
            out.extend(known.get(part) or self.word(part))
        return out

    def decode(self, ids: list[int] | None) -> str:
        """The inverse machine: what the pieces write, the front mark dropped, read as UTF-8 (a wrong byte is replaced)."""
        if not ids:
            return ""
        if not self.controls.isdisjoint(ids):  # bytes do not join across a control piece
            cuts = [k for k, i in enumerate(ids) if i in self.controls]
            runs = [ids[a + 1:b] for a, b in zip([-1, *cuts], [*cuts, len(ids)])]
            full = [run for run in runs if run]
            return "".join([self.decode(full[0]), *[self._read(run) for run in full[1:]]]) if full else ""
        text = self._read(ids)
        return text[1:] if self.model.dummy_prefix and self.model.pieces[ids[0]][0].startswith(MARK) else text

    def decode_all(self, lists: pa.ListArray) -> list[str]:
        """Every list decoded: what the pieces write is gathered for all lists at once."""
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.bytes_of_all[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        odd = np.isin(ids, list(self.controls))
        out = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            try:
                if odd[low:high].any():
                    raise UnicodeError
                text = data[ends[low]:ends[high]].decode()
                out.append(text[1:] if low < high and self.model.dummy_prefix and self.model.pieces[ids[low]][0].startswith(MARK) else text)
            except UnicodeError:
                out.append(self.decode(ids[low:high].tolist()))
        return out

    def _read(self, ids: list[int]) -> str:
        data = b"".join(map(self.written.__getitem__, ids))
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="replace_each")


def _replace_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


codecs.register_error("replace_each", _replace_each)

_MADE: dict[int, Transducer] = {}


def transducer(data: bytes) -> Transducer:
    """The machines of a model, compiled once per Python process."""
    key = zlib.crc32(data)
    if key not in _MADE:
        _MADE[key] = Transducer(Model(data))
    return _MADE[key]


def load(path: str = MODEL) -> bytes:
    """The bytes of a model file, half a megabyte; the driver reads it and tasks get a copy."""
    with open(path, "rb") as file:
        return file.read()


def _mapped(docs: DataFrame, column: str, added: dict[str, str], fn: Callable[[Transducer, pa.Array], list[pa.Array]], model: bytes) -> DataFrame:
    """`docs` with columns (name: type) of what `fn` of the machines makes of arrays of `column`."""
    taken = {name.lower() for name in added}
    names = [c for c in docs.columns if c.lower() not in taken]
    rows = docs.select(F.col(f"`{column}`").alias(fresh(docs, "source")), *[F.col(f"`{c}`") for c in names])
    schema = StructType(rows.schema.fields[1:])
    for name, kind in added.items():
        schema = schema.add(name, StructType.fromDDL(f"made {kind}").fields[0].dataType)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *fn(machine, part.column(0))], [*names, *added])

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, model: bytes, text: str = "text", to: str = "ids", back: str | None = None) -> DataFrame:
    """`docs` with an array of piece numbers; empty for a null or empty text. A column of that name is replaced.

    With `back` a column of that name holds what they decode to, made in the same pass.
    """
    def both(machine: Transducer, texts: pa.Array) -> list[pa.Array]:
        ids = pa.array([machine.encode(x.as_py()) for x in texts], pa.list_(pa.int32()))
        return [ids] if back is None else [ids, pa.array(machine.decode_all(ids), pa.string())]

    added = {to: "array<int>"} if back is None else {to: "array<int>", back: "string"}
    return _mapped(docs.withColumn(text, F.col(f"`{text}`").cast("string")), text, added, both, model)


def decode(docs: DataFrame, model: bytes, ids: str = "ids", to: str = "text") -> DataFrame:
    """`docs` with the text of an array of piece numbers; empty for a null or empty array. A column of that name is replaced.

    Decoding undoes encoding, but that a mark written in the text itself comes back as a space.
    """
    return _mapped(docs, ids, {to: "string"}, lambda machine, lists: [pa.array(machine.decode_all(lists), pa.string())], model)
