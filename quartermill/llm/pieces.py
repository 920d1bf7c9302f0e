"""Piece encoding with source offsets, and decoding, for byte-pair piece models.

A text is normalised by longest-prefix matches through the compiled character map of the model, which
also records the source byte each normalised byte comes from. The normalised text is merged into
pieces, and every piece is projected back to the byte span of the original text it stands for.

Merges never cross a place before a space mark or around a character that no longer piece contains,
so a text falls into units that are merged once per worker and remembered. Models without a character
map take this way, and the library merges their unseen units; others are merged whole, here.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from quartermill.llm.common import Memo, column_type, kept_for_worker, map_texts, text_or_empty

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
BPE_MODEL = 2
#: Remembered units per worker (and as many older ones).
MEMO = 200_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = varint(at)
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class CharacterMap:
    """Longest-prefix replacement through a compiled map: a double-array trie and its replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """Replacement of the longest entry that starts at ``at`` and its length; (b"", 0) without one."""
        units, found = self.units, None
        if not units:
            return b"", 0
        node = _child_base(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            leaf = units[node] >> 8 & 1
            node ^= _child_base(units[node])
            if leaf:
                found = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return b"", 0
        start, length = found
        return self.strings[start:self.strings.index(b"\0", start)], length


def _child_base(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    def __init__(self, data: bytes):
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.surface: list[str] = []
        self.kinds: list[int] = []
        self.byte_ids: dict[int, int] = {}
        self.unused: set[str] = set()
        user: list[str] = []
        flags = {3: 1, 4: 1, 5: 1}  # dummy prefix, extra spaces removed, spaces escaped
        trainer: dict[int, object] = {}
        charsmap = b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self._add(piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL), user)
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                for number, item in _fields(value):
                    if number in flags:
                        flags[number] = item
                    elif number == 2:
                        charsmap = item
        if trainer.get(3, 1) != BPE_MODEL:
            raise ValueError("only models of the byte-pair type are supported")
        if trainer.get(24, 0):
            raise ValueError("models with spaces as suffixes are not supported")
        self.dummy_prefix, self.strip_spaces, self.escape = (bool(flags[n]) for n in (3, 4, 5))
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode()
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = next((i for i, k in enumerate(self.kinds) if k == CONTROL and self.surface[i] == trainer.get(47, b"</s>").decode()), None)
        self.map = CharacterMap(charsmap)
        self.user = re.compile("|".join(map(re.escape, sorted(user, key=len, reverse=True)))) if user else None
        self.lengths = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(self.surface, self.kinds)], np.int64)
        self.plain = not charsmap and not self.strip_spaces and self.escape and self.user is None
        self.newline_apart = not any("\n" in p for p in self.ids)
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.unit = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*|[^{SPACE}\n]+") if not inner and self.newline_apart and not user else None
        self.out = [b"" if k == CONTROL else self.unknown_surface.encode() if k == UNKNOWN
                    else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                    for p, k in zip(self.surface, self.kinds)]
        self.units = Memo(lambda key: array("i", self.merge(key if key[:1] == "\n" else SPACE + key)).tobytes(), MEMO)
        self.decimals = [str(i) for i in range(len(self.surface))]
        self.library = None
        if self.plain and self.unit is not None and self.dummy_prefix and self.byte_ids:
            self.library = SentencePieceProcessor(model_proto=data)

    def _add(self, piece: str, score: float, kind: int, user: list[str]) -> None:
        at = len(self.surface)
        self.surface.append(piece)
        self.kinds.append(kind)
        if kind in (NORMAL, USER_DEFINED, UNUSED):
            self.ids[piece] = at
            self.rank[piece] = -score
            if kind == UNUSED:
                self.unused.add(piece)
            elif kind == USER_DEFINED:
                user.append(piece)
        elif kind == BYTE:
            self.byte_ids[int(piece[3:5], 16)] = at

    # Normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its UTF-8 bytes and its end, the source byte it starts at."""
        data = text.encode()
        if self.plain:
            return ((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""), self._plain(text, data)
        out, origin, at = [], [], 0
        space = SPACE if self.escape else " "
        if self.strip_spaces:
            while at < len(data):
                replaced, length = self._step(data, at)
                if replaced != b" ":
                    break
                at += length
        if at == len(data):
            return "", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out.append(space.encode())
            origin += [at] * len(out[0])
        after_space = self.strip_spaces
        while at < len(data):
            replaced, length = self._step(data, at)
            if after_space:
                replaced = replaced.lstrip(b" ")
            if replaced:
                bytes_ = replaced.replace(b" ", space.encode())
                out.append(bytes_)
                origin += [at] * len(bytes_)
                after_space = replaced.endswith(b" ")
            at += length
            if not self.strip_spaces:
                after_space = False
        end = at
        joined = b"".join(out)
        if self.strip_spaces:
            mark = space.encode()
            while joined.endswith(mark):
                joined = joined[:-len(mark)]
                end = origin[len(joined)]
                del origin[len(joined):]
        return joined.decode("utf-8", "replace"), np.array([*origin, end], np.int64)

    def _step(self, data: bytes, at: int) -> tuple[bytes, int]:
        """Replacement of what stands at ``at`` and how many bytes it replaces."""
        if self.user is not None:
            found = self.user.match(data[at:at + 1024].decode("utf-8", "ignore"))
            if found:
                piece = found[0].encode()
                return piece, len(piece)
        replaced, length = self.map.longest(data, at)
        if length:
            return replaced, length
        first = data[at]
        length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at:at + length], length

    def _plain(self, text: str, data: bytes) -> np.ndarray:
        """Source bytes when the map is empty: only spaces change, each into a mark of three bytes."""
        if not data:
            return np.zeros(1, np.int64)
        codes = np.frombuffer(data, np.uint8)
        places = np.arange(len(codes), dtype=np.int64)
        starts = places if text.isascii() else np.maximum.accumulate(np.where(codes & 0xC0 != 0x80, places, 0))
        origin = np.repeat(starts, np.where(codes == 32, 3, 1))
        return np.concatenate([np.zeros(3 if self.dummy_prefix else 0, np.int64), origin, [len(data)]])

    # Merging

    def _keys(self, text: str) -> list[str]:
        """Units of a text: a key that begins with a line break is a unit, any other is one without its mark.

        Only for plain models with a dummy prefix, where every unit begins with a mark or a line break.
        """
        if not text:
            return []
        if text[0] == " " or "  " in text or " \n" in text or SPACE in text:
            normal = SPACE + text.replace(" ", SPACE)
            return [u[1:] if u[0] == SPACE else u for u in self.unit.findall(normal)]
        return text.replace("\n", " \n").split(" ")

    def merge(self, unit: str) -> list[int]:
        """Ids of one unit: the pair with the best score merges first, the leftmost among equals."""
        symbols = list(unit) if self.user is None else self._symbols(unit)
        undo: dict[str, tuple[str, str]] = {}
        if len(symbols) <= 40:
            symbols = self._merge_short(symbols, undo)
        else:
            symbols = self._merge_long(symbols, undo)
        out: list[int] = []
        for symbol in symbols:
            self._emit(symbol, undo, out)
        return out

    def _symbols(self, unit: str) -> list[str]:
        out, at = [], 0
        for found in self.user.finditer(unit):
            out += [*unit[at:found.start()], found[0]]
            at = found.end()
        return out + list(unit[at:])

    def _emit(self, symbol: str, undo: dict[str, tuple[str, str]], out: list[int]) -> None:
        if symbol in self.unused and symbol in undo:
            for part in undo[symbol]:
                self._emit(part, undo, out)
            return
        found = self.ids.get(symbol)
        if found is not None:
            out.append(found)
        elif self.byte_ids:
            out += [self.byte_ids[b] for b in symbol.encode()]
        else:
            out.append(self.unknown)

    def _merge_short(self, symbols: list[str], undo: dict) -> list[str]:
        rank, far = self.rank, float("inf")
        fixed = self.user is not None
        joins = [far if fixed and (self._whole(a) or self._whole(b)) else rank.get(a + b, far)
                 for a, b in zip(symbols, symbols[1:])]
        while joins:
            best = min(joins)
            if best == far:
                break
            i = joins.index(best)
            merged = symbols[i] + symbols[i + 1]
            if merged in self.unused:
                undo[merged] = symbols[i], symbols[i + 1]
            symbols[i:i + 2] = [merged]
            del joins[i]
            if i:
                joins[i - 1] = far if fixed and self._whole(symbols[i - 1]) else rank.get(symbols[i - 1] + merged, far)
            if i < len(joins):
                joins[i] = far if fixed and self._whole(symbols[i + 1]) else rank.get(merged + symbols[i + 1], far)
        return symbols

    def _whole(self, symbol: str) -> bool:
        return self.kinds[self.ids[symbol]] == USER_DEFINED if symbol in self.ids else False

    def _merge_long(self, symbols: list[str], undo: dict) -> list[str]:
        """The same in n log n steps for long units, with a queue of joinable pairs."""
        rank, n = self.rank, len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and not (self.user is not None and (self._whole(symbols[i]) or self._whole(symbols[j]))):
                joined = symbols[i] + symbols[j]
                if joined in rank:
                    heapq.heappush(queue, (rank[joined], i, j, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, joined = heapq.heappop(queue)
            if not symbols[i] or not symbols[j] or right[i] != j or symbols[i] + symbols[j] != joined:
                continue
            if joined in self.unused:
                undo[joined] = symbols[i], symbols[j]
            symbols[i], symbols[j] = joined, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s in symbols if s]

    def _known(self, keys: list[str]) -> bytes:
        """Ids of all units. The library merges new ones: it does in compiled code what ``merge`` does.

        It puts its own mark before what it is given, so a unit that begins with a line break, which
        never merges, gets one id too many in front.
        """
        known = self.units
        found = list(map(known.get, keys))
        if None in found:
            new = [i for i, ids in enumerate(found) if ids is None]
            older = known.older
            unseen = list({keys[i]: None for i in new if keys[i] not in older and keys[i]})
            if unseen:
                for key, ids in zip(unseen, self.library.encode(unseen, num_threads=1)):
                    known.put(key, array("i", ids[1:] if key[0] == "\n" else ids).tobytes())
            for i in new:
                found[i] = known[keys[i]]
        return b"".join(found)

    # Texts

    def encode(self, text: str, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and the source span of each piece (of the end id: empty)."""
        if self.library is not None:
            origin = self._plain(text, text.encode())
            ids = np.frombuffer(self._known(self._keys(text)), np.int32)
        else:
            normal, origin = self.normalise(text)
            ids = np.array(self.merge(normal), np.int32)
        if self.byte_ids:
            edges = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        else:
            ids, edges = self._unknown_runs(normal, ids)
        begins, ends = origin[edges[:-1]], origin[edges[1:]]
        if end and self.end is not None:
            ids = np.append(ids, np.int32(self.end))
            begins, ends = np.append(begins, origin[-1]), np.append(ends, origin[-1])
        return ids, begins, ends

    def _unknown_runs(self, normal: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without byte pieces, neighbouring unknown characters are one piece."""
        sizes, at, chars = [], 0, normal
        for i in ids.tolist():
            piece = chars[at] if i == self.unknown else self.surface[i]
            sizes.append(len(piece.encode()))
            at += len(piece)
        edges = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        if len(ids) == 0:
            return ids, edges
        first = np.concatenate([[True], ~((ids[1:] == self.unknown) & (ids[:-1] == self.unknown))])
        return ids[first], np.append(edges[:-1][first], edges[-1])

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ``ids``: marks become spaces, the one of the dummy prefix goes, byte pieces are joined."""
        out = self.out
        data = b"".join([out[i] for i in ids])
        if self.dummy_prefix or self.strip_spaces:
            for i in ids:
                if self.kinds[i] == CONTROL:
                    continue
                if self.surface[i].startswith(SPACE) and self.kinds[i] in (NORMAL, USER_DEFINED, UNUSED):
                    data = data.lstrip(b" ") if self.strip_spaces else data[1:]
                break
        return data.decode("utf-8", "replace")


def load(data: bytes) -> PieceModel:
    return PieceModel(data)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: Type of each output that ``encode`` can add.
OUTPUTS = {
    "ids": "array<int>", "begins": "array<bigint>", "ends": "array<bigint>", "decoded": "string",
    "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "span_bytes": "bigint",
}


def encode(df: DataFrame, model: str, text: str = "text", keep: Sequence[str] = ("doc_id",),
           outputs: Sequence[str] = ("ids", "begins", "ends", "decoded"), end: bool = True) -> DataFrame:
    """Encode every whole text with the piece model at path ``model`` and decode the ids again.

    One row per row of ``df``, with the columns ``keep`` and the ``outputs``: ids, the byte span of the
    source text of each piece (``begins``, ``ends``), the decoded text, their number, digests, and
    ``span_bytes``, the bytes of the text that the spans cover. A null text counts as empty and an
    empty one has only the end id. Repeated rows give repeated rows, an empty table an empty one;
    columns of ``df`` that are not in ``keep`` are never read, so their names cannot clash.
    The model file is read on the driver and broadcast: its size is that of one vocabulary.
    """
    clash = set(keep) & set(outputs)
    if clash:
        raise ValueError(f"output names in keep: {sorted(clash)}")
    with open(model, "rb") as file:
        data = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(data), ("pieces", hashlib.sha256(data).hexdigest())
    keep, outputs = list(keep), list(outputs)
    schema = ", ".join([f"`{c}` {column_type(df, c)}" for c in keep] + [f"{o} {OUTPUTS[o]}" for o in outputs])

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        codec = kept_for_worker(key, lambda: load(shared.value))
        made: dict[str, list] = {o: [] for o in outputs}
        decimals = codec.decimals
        for value in batch["_text"]:
            ids, begins, ends = codec.encode(value, end)
            listed = ids.tolist()
            for name in outputs:
                made[name].append(
                    ids if name == "ids" else begins if name == "begins" else ends if name == "ends"
                    else codec.decode(listed) if name == "decoded" else len(listed) if name == "n_tokens"
                    else _sha256(" ".join([decimals[i] for i in listed])) if name == "ids_sha256"
                    else _sha256(codec.decode(listed)) if name == "decoded_sha256"
                    else int((ends - begins).sum()))
        return pd.DataFrame({**{c: batch[c] for c in keep}, **made}, columns=[*keep, *outputs])

    return map_texts(df.select(*[F.col(c) for c in keep], text_or_empty(text).alias("_text")), schema, rows)
