"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of its documents one after the other, cut into blocks of a fixed number of ids. A block
stores its least id, what the others are above it in as many bits as a percentile of them needs, and
the upper bits of the few that need more as exceptions. The footer has the place of every block and the end of every
document, so any range of ids is read from the blocks that hold it.

    file    = { segment "\\n" } footer "\\n"       written by Spark's text writer, a row for each segment
    segment = blocks, one after the other
    block   = least u32, bits u8, exceptions u16, ids u16, packed values, exception places u8 each, upper bits u32 each
    footer  = block starts u64 each, document ends u64 each, document names (u32 length or NO_NAME, UTF-8), trailer
    trailer = part u64, blocks u64, documents u64, ids u64, length of the footer without the trailer u64, MAGIC

All numbers are little-endian. Files are in order of their part, documents in order of their id.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quartermill.llm.common import Memo, column_type, kept_for_worker, text_or_empty
from quartermill.llm.prefix_tokens import _byte_letters
from quartermill.session import materialise

# Fixed values of the format.
MAGIC, NO_NAME, HEADER = b"PFORIDS1", 0xFFFFFFFF, 9
TRAILER = "<QQQQQ8s"
BLOCK, PERCENTILE = 256, 90  # ids of a block (at most 256, for places of one byte) and the share of them that fits the width
SEGMENT_BLOCKS = 2048
#: Text of one file, in characters, about.
FILE_CHARS = 64_000_000

# Blocks


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each number below 2**32 needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Rows of numbers, each in ``bits`` bits: eight numbers fill as many bytes as they have bits."""
    n, size = values.shape
    padded = np.zeros((n, -(-size // 8) * 8), np.uint64 if bits > 25 else np.uint32)
    padded[:, :size] = values
    eights = padded.reshape(n, -1, 8)
    out = np.zeros((n, eights.shape[1], bits), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = eights[:, :, k] << shift
        for j in range(-(-(shift + bits) // 8)):
            out[:, :, byte + j] |= (value >> (8 * j)).astype(np.uint8)
    return out.reshape(n, -1)


def _unpacked(rows: np.ndarray, bits: int, size: int) -> np.ndarray:
    n = len(rows)
    eights = rows.reshape(n, -1, bits)
    kind = np.uint64 if bits > 25 else np.uint32
    out = np.empty((n, eights.shape[1], 8), kind)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = eights[:, :, byte].astype(kind)
        for j in range(1, -(-(shift + bits) // 8)):
            value |= eights[:, :, byte + j].astype(kind) << (8 * j)
        out[:, :, k] = value >> shift & ((1 << bits) - 1)
    return out.reshape(n, -1)[:, :size]


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks of ``ids``, the last of which may be short, and where each block starts."""
    whole = len(ids) // BLOCK * BLOCK
    parts = [ids[:whole].reshape(-1, BLOCK)] + ([ids[whole:].reshape(1, -1)] if whole < len(ids) else [])
    made = [_encode(part, percentile) for part in parts if part.size]
    if not made:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    shift = np.cumsum([0] + [len(data) for data, _ in made[:-1]])
    return np.concatenate([data for data, _ in made]), np.concatenate([starts + s for (_, starts), s in zip(made, shift)])


def _encode(blocks: np.ndarray, percentile: int) -> tuple[np.ndarray, np.ndarray]:
    n, size = blocks.shape
    least = blocks.min(axis=1)
    above = blocks - least[:, None]
    kth = -(-size * percentile // 100) - 1
    bits = _bits(np.partition(above, kth, axis=1)[:, kth])
    upper = above >> np.minimum(bits, 31).astype(np.uint32)[:, None]
    upper[bits == 32] = 0
    row, place = np.nonzero(upper)
    exceptions = np.bincount(row, minlength=n)
    packed = (size + 7) // 8 * bits
    length = HEADER + packed + 5 * exceptions
    starts = np.cumsum(length) - length
    header = np.zeros(n, np.dtype([("least", "<u4"), ("bits", "u1"), ("exceptions", "<u2"), ("ids", "<u2")]))
    header["least"], header["bits"], header["exceptions"], header["ids"] = least, bits, exceptions, size
    values = [b""] * n
    for width in np.unique(bits[bits > 0]).tolist():
        own = np.flatnonzero(bits == width)
        raw, step = _packed(above[own] & np.uint32((1 << width) - 1), width).tobytes(), (size + 7) // 8 * width
        for at, k in enumerate(own.tolist()):
            values[k] = raw[at * step:(at + 1) * step]
    places, uppers, heads = place.astype(np.uint8).tobytes(), upper[row, place].astype("<u4").tobytes(), header.tobytes()
    parts, done = [], 0
    for k, more in enumerate(exceptions.tolist()):
        parts += (heads[k * HEADER:(k + 1) * HEADER], values[k])
        if more:
            parts += (places[done:done + more], uppers[4 * done:4 * (done + more)])
            done += more
    return np.frombuffer(b"".join(parts), np.uint8), starts


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts`` of ``data``, one after the other."""
    n, raw = len(starts), memoryview(np.ascontiguousarray(data))
    header = data[starts[:, None] + np.arange(HEADER)].reshape(-1).view(np.dtype([("least", "<u4"), ("bits", "u1"), ("exceptions", "<u2"), ("ids", "<u2")]))
    bits, size, exceptions = (header[k].astype(np.int64) for k in ("bits", "ids", "exceptions"))
    packed = (size + 7) // 8 * bits
    out = np.zeros((n, BLOCK), np.uint32)
    for width, ids in sorted(set(zip(bits.tolist(), size.tolist()))):
        own = np.flatnonzero((bits == width) & (size == ids))
        for at in range(0, len(own) if width else 0, SEGMENT_BLOCKS):
            some = own[at:at + SEGMENT_BLOCKS]
            step = (ids + 7) // 8 * width
            rows = np.frombuffer(b"".join([raw[at:at + step] for at in (starts[some] + HEADER).tolist()]), np.uint8).reshape(len(some), step)
            out[some, :ids] = _unpacked(rows, width, ids)
    if exceptions.any():
        block = np.repeat(np.arange(n), exceptions)
        nth = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
        at = starts[block] + HEADER + packed[block]
        upper = data[(at + exceptions[block] + 4 * nth)[:, None] + np.arange(4)].reshape(-1).view("<u4")
        out[block, data[at + nth]] |= upper << bits[block].astype(np.uint32)
    out += header["least"][:, None]
    return out.reshape(-1) if (size == BLOCK).all() else out[np.arange(BLOCK) < size[:, None]]


class FileWriter:
    """Turns the documents of one file into its rows."""

    def __init__(self, part: int):
        self.part, self.names, self.ends, self.starts = part, [], [], []
        self.held, self.n_held, self.total, self.at = [], 0, 0, 0

    def add(self, name: str | None, ids: np.ndarray) -> Iterator[bytes]:
        self.names.append(name)
        self.total += len(ids)
        self.ends.append(self.total)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= SEGMENT_BLOCKS * BLOCK:
            yield from self._segment(self.n_held // BLOCK * BLOCK)

    def _segment(self, n: int) -> Iterator[bytes]:
        ids = np.concatenate(self.held)
        for at in range(0, n, SEGMENT_BLOCKS * BLOCK):
            data, starts = encode_blocks(ids[at:min(n, at + SEGMENT_BLOCKS * BLOCK)])
            self.starts.append(starts + self.at)
            self.at += len(data) + 1
            yield data.tobytes()
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> Iterator[bytes]:
        if self.n_held:
            yield from self._segment(self.n_held)
        starts = np.concatenate(self.starts) if self.starts else np.zeros(0, np.int64)
        names = b"".join(struct.pack("<I", NO_NAME) if name is None else struct.pack("<I", len(raw := name.encode())) + raw for name in self.names)
        body = starts.astype("<u8").tobytes() + np.array(self.ends, "<u8").tobytes() + names
        yield body + struct.pack(TRAILER, self.part, len(starts), len(self.names), self.total, len(body), MAGIC)


class FileReader:
    """Reads one file from its bytes."""

    def __init__(self, content: bytes):
        end, size = len(content) - 1, struct.calcsize(TRAILER)  # the writer ends the last row, too
        self.part, blocks, self.documents, self.total, length, magic = struct.unpack_from(TRAILER, content, end - size)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        foot = end - size - length
        self.data = np.frombuffer(content, np.uint8)
        self.starts = np.frombuffer(content, "<u8", blocks, foot).astype(np.int64)
        self.ends = np.frombuffer(content, "<u8", self.documents, foot + 8 * blocks).astype(np.int64)
        self.names, at = [], foot + 8 * (blocks + self.documents)
        for _ in range(self.documents):
            (size,) = struct.unpack_from("<I", content, at)
            at += 4
            if size == NO_NAME:
                self.names.append(None)
            else:
                self.names.append(content[at:at + size].decode())
                at += size

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first = start // BLOCK
        return decode_blocks(self.data, self.starts[first:-(-end // BLOCK)])[start - first * BLOCK:end - first * BLOCK]

    def by_document(self) -> Iterator[tuple[str | None, int, np.ndarray]]:
        """Name, start and ids of every document; blocks are decoded a run of them at a time."""
        reach = SEGMENT_BLOCKS * BLOCK
        held, begin = np.zeros(0, np.uint32), 0  # ids from ``begin`` on
        start = 0
        for name, end in zip(self.names, self.ends.tolist()):
            if end > begin + len(held):
                upto = min(self.total, max(end, start + reach))
                held, begin = self.ids(start, upto), start
            yield name, start, held[start - begin:end - begin]
            start = end


# Encoding


class Encoder:
    """Ids of texts as the library gives them.

    Where normalisation and splitting can't reach across white space and drop it, texts are cut there and the
    ids of the parts remembered. A part that is one word of Latin letters, but for a final mark, goes to the library's merges
    right away, because normalising and splitting only change its case; any other part goes through the whole library.
    """

    # The steps whose result for a text is that of its parts between white space.
    STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    MEMO, RUN = 400_000, 1 << 20
    BEYOND_LATIN = "\u0250"

    def __init__(self, data: bytes):
        spec = json.loads(data)
        self.library = Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.word = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        steps, split = (spec.get("normalizer") or {}).get("normalizers"), (spec.get("pre_tokenizer") or {}).get("pretokenizers")
        self.parted = (
            steps == self.STEPS and bool(split) and len(split) == 2 and split[0].get("pattern") == {"Regex": self.SPLIT}
            and split[0].get("behavior") == "Removed" and split[0].get("invert") is True
            and split[1].get("type") == "ByteLevel" and split[1].get("add_prefix_space") is False and split[1].get("use_regex") is False
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() or c.isalpha() and len(t["content"]) == 1 for c in t["content"]) for t in spec["added_tokens"])
            and not any(t["content"].isalpha() for t in spec["added_tokens"]) and not spec["model"].get("dropout"))
        self.code = "H" if self.word.itemsize == 2 else "I"
        self.letters = {byte: letter for letter, byte in _byte_letters().items()}
        self.merges = self.library.model
        self.parts = Memo(self._part, self.MEMO)

    def _library(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.word) for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _is_latin(self, word: str) -> bool:
        return word.isalpha() and max(word) < self.BEYOND_LATIN and word.lower().isalpha()

    def _merged(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return array(self.code, [token.id for token in self.merges.tokenize(shown)]).tobytes()

    def _part(self, part: bytes) -> bytes:
        if part.isalpha():  # letters from a to z only
            small = part.lower()
            return self._merged(part.decode()) if small == part else self.parts[small]
        mark = part[-1:]
        if part[:-1].isalpha() and not mark.isalnum() and mark < b"\x80":
            return self.parts[part[:-1].lower()] + self.parts[mark]
        text = part.decode()
        if self._is_latin(text):
            small = text.lower()
            return self._merged(text) if small == text else self.parts[small.encode()]
        if text[-1].isascii() and not text[-1].isalnum() and self._is_latin(text[:-1]):
            return self.parts[text[:-1].lower().encode()] + self.parts[mark]
        return self._library([text])[0].tobytes()

    def _runs(self, text: str) -> Iterator[list[bytes]]:
        data, at = text.encode(), 0
        while at < len(data):
            end = at + self.RUN
            while end < len(data) and data[end] not in b" \t\n\v\f\r":
                end += 1
            yield data[at:end].split()
            at = end

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if not self.parted:
            return self._library(texts)
        get = self.parts.__getitem__
        return [np.frombuffer(b"".join(b"".join(map(get, run)) for run in self._runs(text)), self.word) for text in texts]


# Steps on Spark


def _bounds(rows: DataFrame, files: int) -> list[tuple]:
    """The least ``(id, tie)`` of every range but the first: at most one row for each file."""
    ranges = rows.filter("id IS NOT NULL").repartitionByRange(files, "id", "tie").groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("id", "tie")).alias("first"))
    return sorted((r["first"]["id"], r["first"]["tie"]) for r in ranges.collect())[1:]


def write_ids(df: DataFrame, tokenizer: str, path: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text",
              file_chars: int = FILE_CHARS) -> None:
    """Encode every whole text without special tokens, append ``end_id`` and write the ids to files in the order of ``doc_id``.

    Null texts are empty, a null id comes first, rows of one id go by a hash of their texts and those of one text
    in any order. Texts are not moved: the bounds of the files come from ids and hashes, so that each text is encoded
    once and only its ids go to the task of its file. The tokenizer file is read on the driver and broadcast.
    """
    spark = df.sparkSession
    with open(tokenizer, "rb") as file:
        data = file.read()
    shared, key = spark.sparkContext.broadcast(data), ("ids", hashlib.sha256(data).hexdigest())
    kind = column_type(df, doc_id)
    rows = df.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // file_chars))
    bounds = _bounds(rows.select("id", "tie"), files)
    ends = spark.sparkContext.broadcast(bounds)

    def encode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_for_worker(key, lambda: Encoder(shared.value))
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.iloc[at:at + 500]
                ids = encoder.encode(list(some["text"]))
                names = [None if n == "" else n[1:] for n in some["name"]]
                values = some["id"].tolist()
                part = [0 if name is None else bisect.bisect_right(ends.value, (value, tie)) for name, value, tie in zip(names, values, some["tie"])]
                yield pd.DataFrame({"part": part, "name": names, "id": some["id"].to_numpy(), "tie": some["tie"].to_numpy(), "size": encoder.word.itemsize, "ids": [i.tobytes() for i in ids]})

    # The name says whether the id is null, which numbers in pandas can't.
    name = F.when(F.col("id").isNull(), "").otherwise(F.concat(F.lit("."), F.col("id").cast("string")))
    whole = F.col("id") if kind == "string" else F.coalesce("id", F.lit(0).cast(kind)) if kind in ("bigint", "int", "smallint", "tinyint") else F.col("id")
    encoded = rows.select("text", "tie", name.alias("name"), whole.alias("id")).mapInPandas(encode, f"part int, name string, id {kind}, tie bigint, size int, ids binary")

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = None
        for batch in batches:
            made = []
            for part, name, size, ids in zip(batch["part"], batch["name"], batch["size"], batch["ids"]):
                writer = writer or FileWriter(part)
                own = np.frombuffer(ids, f"<u{size}").astype(np.uint32)
                made += writer.add(name, own if end_id is None else np.append(own, np.uint32(end_id)))
                if len(made) > 64:
                    yield pd.DataFrame({"row": made})
                    made = []
            if made:
                yield pd.DataFrame({"row": made})
        if writer:
            yield pd.DataFrame({"row": list(writer.close())})

    order = ["part", F.col("name").isNotNull(), "id", "tie"]
    made = encoded.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(*order).mapInPandas(write, "row binary")
    made.select(F.col("row").cast("string")).write.option("lineSep", "\n").text(path)


def read_documents(spark: SparkSession, path: str, id_type: str = "bigint", ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` and, if asked for, ``ids`` of every document of the files under ``path``.

    ``start`` counts the ids of all documents before it: those of the file come from its footer, those of earlier files
    from one row for each file.
    """

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                if not len(content):
                    continue
                file, made = FileReader(content), []
                for name, start, own in file.by_document():
                    raw = own.astype("<u4")
                    made.append((file.part, name, start, len(own), zlib.crc32(raw.tobytes()), own.astype(np.int32) if ids else None))
                    if len(made) >= 2000:
                        yield pd.DataFrame(made, columns=columns)
                        made = []
                if made:
                    yield pd.DataFrame(made, columns=columns)

    columns = ["part", "name", "start", "n_tokens", "ids_crc32", "ids"]
    files = spark.read.format("binaryFile").load(path).select("content")
    found = materialise(files.mapInPandas(read, "part bigint, name string, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"), "read")
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # one row for each file
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    out = found.join(F.broadcast(offsets), "part").select(
        F.col("name").cast(id_type).alias("doc_id"), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return out if ids else out.drop("ids")


def round_trip(df: DataFrame, tokenizer: str, path: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Write the ids of ``df`` to ``path`` and read the documents back from the files.

    One row for each row of ``df``: also for null and empty texts, which have the end id only, for null ids and
    for repeated rows. An empty table gives no file and no rows; other columns are not read.
    """
    spark = df.sparkSession
    kind = column_type(df, doc_id)
    if df.isEmpty():
        out = spark.createDataFrame([], f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>")
        return out if ids else out.drop("ids")
    write_ids(df, tokenizer, path, end_id, doc_id, text)
    return read_documents(spark, path, kind, ids)
