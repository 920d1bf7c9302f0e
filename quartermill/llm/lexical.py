"""Ranked lexical search: Block-Max MaxScore over an index that is cut into shards of documents.

A shard is a run of documents of one task, with an inverted list for each of its terms. A list is cut at
fixed numbers of documents into blocks; a block holds its documents and frequencies compressed, and
beside them the few pairs of frequency and document length that can give its highest score, so that its
maximum is exact whatever the statistics of the whole collection are.

A search looks at every shard. The highest scores of whole lists tell which lists are essential: a document that
is in none of these can't reach the heap. Blocks are taken from the one with the highest bound on; the essential lists give
candidates, and the maxima of the blocks of the other lists reject candidates before these blocks are
decompressed. Each task carries its heaps from shard to shard; the heaps of the tasks are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.llm.common import column_type, text_or_empty, whole_groups
from quartermill.session import materialise

# The characters of terms (as bytes, where only A to Z change case) and the scale of the score.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SCALE, SATURATION, LENGTH, FLAT, SLOPE = 1_000_000_000, 1000, 8, 10, 90
PIECE = 1 << 20


@dataclass(frozen=True)
class IndexSettings:
    block_docs: int = 512  # documents a block spans
    shard_docs: int = 8192  # a shard ends after so many documents ...
    shard_terms: int = 1 << 21  # ... or so many occurrences of terms
    group_items: int = 512  # items that are searched together


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Terms of a whole text in order, in lists that cover a piece of it each."""
    data = text.encode()
    at = 0
    while at < len(data):
        cut = SEPARATOR.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield TERM.findall(data[at:end].lower())
        at = end


class _Numbers(dict):
    """Numbers terms in the order in which they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


# Compressed blocks


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits each, the last byte of a number below 128, and the end of every number."""
    sizes = np.ones(len(values), np.int64)
    for shift in range(7, 63, 7):
        more = values >= 1 << shift
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out, starts = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8), ends - sizes
    for k in range(int(sizes.max(initial=0))):
        there = sizes > k
        more = np.where(sizes[there] > k + 1, 128, 0)
        out[starts[there] + k] = (values[there] >> (7 * k) & 127) | more
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    last = data < 128
    if last.all():
        return data.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shifts = 7 * (np.arange(len(data)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shifts, starts)


def _frontiers(block: np.ndarray, frequency: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which postings of each block have no other with a higher frequency in a document as short."""
    order = np.lexsort((length, -frequency, block))
    far = int(length.max(initial=0)) + 1
    value = length[order] - block[order] * far  # falls from block to block, so the least so far starts anew in each
    least = np.minimum.accumulate(value)
    best = np.ones(len(value), bool)
    best[1:] = value[1:] < least[:-1]
    return order[best]


def _starts(changed: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(changed) + 1]) if len(changed) else np.zeros(1, int)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of one buffer as binary values, the first of them null."""
    offsets = np.concatenate([[0, 0], ends]).astype(np.int32)
    there = np.packbits(np.concatenate([[0], np.ones(len(ends), np.uint8)]), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(ends) + 1, [pa.py_buffer(there), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class _Shard:
    """Collects documents and gives the rows of their index: one of the documents, then one for each term."""

    def __init__(self):
        self.numbers, self.ids, self.found, self.lengths, self.size = _Numbers(), [], [], [], 0

    def add(self, doc_id, text: str) -> None:
        parts = [np.fromiter(map(self.numbers.__getitem__, part), np.int32, len(part)) for part in terms_of(text)]
        n = sum(map(len, parts))
        if n:
            self.ids.append(doc_id)
            self.found += parts
            self.lengths.append(n)
            self.size += n

    def rows(self, shard: int, s: IndexSettings, id_type: pa.DataType) -> pa.RecordBatch:
        docs = len(self.ids)
        order = sorted(range(docs), key=lambda i: (self.ids[i] is None, self.ids[i]))
        place = np.empty(docs, np.int64)
        place[order] = np.arange(docs)
        lengths = np.array(self.lengths, np.int64)[order]
        keys = np.concatenate(self.found).astype(np.int64) * docs
        keys += np.repeat(place, self.lengths)
        keys.sort()
        first = _starts(keys[1:] != keys[:-1])
        frequency = np.diff(np.append(first, len(keys)))
        term, doc = np.divmod(keys[first], docs)

        block_key = term * (docs // s.block_docs + 1) + doc // s.block_docs
        starts = _starts(block_key[1:] != block_key[:-1])
        size = np.diff(np.append(starts, len(doc)))
        number = np.repeat(np.arange(len(starts)), size)
        gap = np.diff(doc, prepend=0) - 1
        gap[starts] = doc[starts] % s.block_docs
        several = frequency > 1
        before = np.cumsum(several) - several
        base = np.cumsum(size + np.add.reduceat(several, starts)) - (size + np.add.reduceat(several, starts))
        values = np.empty(len(doc) + int(several.sum()), np.int64)
        values[base[number] + np.arange(len(doc)) - starts[number]] = gap << 1 | ~several
        values[(base + size - before[starts])[number[several]] + before[several]] = frequency[several]
        data, ends = pack(values)
        block_end = ends[np.append(base[1:], len(values)) - 1]

        front = _frontiers(number, frequency, lengths[doc])
        front_end = np.cumsum(np.bincount(number[front], minlength=len(starts)))
        pairs = np.stack([frequency[front], lengths[doc[front]]], axis=1).astype("<i4")

        term_start = _starts(term[starts[1:]] != term[starts[:-1]])  # in blocks
        term_blocks = np.diff(np.append(term_start, len(starts)))
        last = np.append(term_start[1:], len(starts)) - 1
        own = lambda ends: ends - np.repeat(np.concatenate([[0], ends[last][:-1]]), term_blocks)
        heads = np.stack([doc[starts] // s.block_docs, size, own(block_end), own(front_end)], axis=1).astype("<i4")
        df = np.add.reduceat(size, term_start)
        n = len(df)
        names = sorted(self.numbers, key=self.numbers.__getitem__)
        nothing = lambda t: pa.nulls(n, t)
        ids = pa.array([[self.ids[i] for i in order if self.ids[i] is not None]], pa.list_(id_type))
        return pa.record_batch([
            pa.array(np.full(n + 1, shard)), pa.array([None, *names], pa.binary()), pa.array(np.append(docs, df)), pa.array(np.append(self.size, np.zeros(n, np.int64))),
            pa.concat_arrays([ids, nothing(ids.type)]), pa.array([lengths.astype("<i4").tobytes(), *[None] * n], pa.binary()),
            _binary(heads.view(np.uint8).reshape(-1), 16 * (last + 1)), _binary(pairs.view(np.uint8).reshape(-1), 8 * front_end[last]), _binary(data, block_end[last]),
        ], names=["shard", "term", "size", "total", "ids", "lengths", "heads", "fronts", "postings"])


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text", s: IndexSettings = IndexSettings()) -> DataFrame:
    """Index of every whole text, a row per shard and term, and one without a term for the documents of the shard.

    A document is a row with at least one term. No row is moved: a shard is what one task reads, up to
    the limits of a shard, so an index grows with the texts and its tasks with the shards.
    """
    id_type = column_type(df, doc_id)
    schema = (f"shard bigint, term binary, size bigint, total bigint, ids array<{id_type}>, lengths binary, heads binary, fronts binary, postings binary")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, kind = TaskContext.get().partitionId() << 32, _Shard(), None
        for batch in batches:
            kind = batch.schema.field("id").type
            for key, value in zip(batch.column("id").to_pylist(), batch.column("text")):
                shard.add(key, value.as_py())
                if len(shard.ids) >= s.shard_docs or shard.size >= s.shard_terms:
                    yield shard.rows(number, s, kind)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield shard.rows(number, s, kind)

    return df.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")).mapInArrow(rows, schema)


# Search


class Documents:
    """The documents of a shard, ordered by id with null last, and their lengths against the mean of all documents."""

    def __init__(self, ids: np.ndarray, lengths: bytes, docs: int, total: int, width: int):
        self.ids, self.docs, self.total, self.width = ids, docs, total, width
        self.lengths = self.weighed(np.frombuffer(lengths, "<i4"))

    def weighed(self, lengths: np.ndarray) -> np.ndarray:
        return FLAT + SLOPE * lengths.astype(np.int64) * self.docs // self.total

    def id(self, place: int):
        return self.ids[place] if place < len(self.ids) else None


class Postings:
    """The list of a term in a shard; blocks are decompressed when they are first asked for."""

    def __init__(self, heads: bytes, fronts: bytes, data: bytes, shard: Documents):
        self.heads = np.frombuffer(heads, "<i4").reshape(-1, 4)
        self.data, self.shard = np.frombuffer(data, np.uint8), shard
        pairs = np.frombuffer(fronts, "<i4").reshape(-1, 2).astype(np.int64)
        gains = np.maximum.reduceat(gain(pairs[:, 0], shard.weighed(pairs[:, 1])), np.concatenate([[0], self.heads[:-1, 3]]))
        #: Highest gain in every block of the shard, 0 where the term is not in it.
        self.most = np.zeros(-(-len(shard.lengths) // shard.width), np.int64)
        self.most[self.heads[:, 0]] = gains
        self.place = {int(b): k for k, b in enumerate(self.heads[:, 0])}
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block, from its first on, and their gains."""
        found = self.opened.get(number)
        if found is None:
            k = self.place[number]
            size, end, start = self.heads[k, 1], self.heads[k, 2], self.heads[k - 1, 2] if k else 0
            values = unpack(self.data[start:end])
            docs = np.cumsum((values[:size] >> 1) + 1) - 1
            frequency = np.ones(size, np.int64)
            frequency[values[:size] & 1 == 0] = values[size:]
            found = self.opened[number] = docs, gain(frequency, self.shard.lengths[number * self.shard.width + docs])
        return found


def gain(frequency: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What one unit of a term's weight adds: rises with the frequency and falls with the length, already weighed against the mean."""
    return SCALE * frequency // (SATURATION * frequency + LENGTH * length)


class Heap:
    """The best documents of an item so far: higher scores first, equal ones by document, null last."""

    def __init__(self, size: int):
        self.size, self.rows = size, []

    @property
    def least(self) -> int:
        """The score a document needs to be of interest; as much as the last one, because equal scores go by document."""
        return -self.rows[-1][0] if len(self.rows) == self.size else 1

    def put(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-int(score), key is None, key) for score, key in zip(scores, ids)]
        self.rows.sort(key=lambda r: r if not r[1] else r[:2])
        del self.rows[self.size:]


def search_shard(lists: list[tuple[int, Postings]], shard: Documents, heap: Heap) -> int:
    """Adds the best documents of a shard to ``heap`` and returns the number of blocks whose postings were looked at."""
    lists = sorted(lists, key=lambda x: x[0] * int(x[1].most.max()))
    weights, looked = [w for w, _ in lists], 0
    most = np.stack([w * p.most for w, p in lists])
    whole = np.cumsum(most.max(axis=1))  # what this list and all weaker ones can give a document
    upto = np.cumsum(most, axis=0)  # the same in each block
    for number in np.argsort(-upto[-1], kind="stable").tolist():
        if upto[-1, number] < heap.least:
            break
        essential = int(np.searchsorted(whole, heap.least))
        score = np.zeros(min(shard.width, len(shard.lengths) - number * shard.width), np.int64)
        for k in range(essential, len(lists)):
            if most[k, number]:
                docs, gains = lists[k][1].block(number)
                score[docs] += weights[k] * gains
                looked += 1
        left = np.flatnonzero(score)
        for k in range(essential - 1, -1, -1):
            left = left[score[left] + upto[k, number] >= heap.least]
            if not len(left):
                break
            if most[k, number]:
                docs, gains = lists[k][1].block(number)
                own = np.zeros(len(score), np.int64)
                own[docs] = weights[k] * gains
                score[left] += own[left]
                looked += 1
        left = left[score[left] >= heap.least]
        if len(left):
            left = left[np.argsort(-score[left], kind="stable")[:heap.size]]
            heap.put(score[left], [shard.id(i) for i in (number * shard.width + left).tolist()])
    return looked


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item, term)``: the distinct terms of each item; rows of one id are one item, rows without an id none."""

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(key, term) for key, value in zip(batch["item"], batch["text"]) for term in {t for part in terms_of(value) for t in part}]
            yield pd.DataFrame(found, columns=["item", "term"])

    source = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), text_or_empty(text).alias("text"))
    return source.mapInPandas(rows, f"item {column_type(items, item_id)}, term binary").distinct()


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text", doc_id: str = "doc_id",
           s: IndexSettings = IndexSettings()) -> DataFrame:
    """``(item, rank, doc, score)``: the ``k`` best documents of each item, over an index that ``build_index`` made with the same settings.

    Only lists of terms that an item has leave the index. The documents of a shard and the lists of up
    to ``group_items`` items meet in one task, so what a task holds is bounded by the size of a shard.
    """
    spark = index.sparkSession
    shards = index.filter("term IS NULL")
    n, total = shards.agg(F.sum("size"), F.sum("total")).first()
    item_type, doc_type = column_type(items, item_id), index.schema["ids"].dataType.elementType.simpleString()
    schema = f"item {item_type}, doc {doc_type}, score bigint"
    if not n:
        return spark.createDataFrame([], f"`{item_id}` {item_type}, rank int, `{doc_id}` {doc_type}, score bigint")
    wanted = materialise(item_terms(items, item_id, text), "wanted")
    groups = max(1, -(-wanted.select("item").distinct().count() // s.group_items))
    grouped = wanted.groupBy("term", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("grp")).agg(F.collect_list("item").alias("items"))
    lists = index.filter("term IS NOT NULL")
    counts = lists.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("size").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1)))
    weighed = materialise(grouped.join(counts, "term").withColumn("weight", weight).filter("weight > 0").drop("df"), "weighed")
    head = shards.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    columns = ["grp", "shard", "term", "weight", "items", "ids", "lengths", "heads", "fronts", "postings"]
    met = lists.join(weighed, "term").select(columns).unionByName(head.select([c for c in columns if c in head.columns]), allowMissingColumns=True)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps, now = {}, None
        for group in whole_groups(batches, ["grp", "shard"]):
            if group["grp"].iat[0] != now:
                yield from _emptied(heaps)
                heaps, now = {}, group["grp"].iat[0]
            first = group.iloc[0]
            shard = Documents(first["ids"], first["lengths"], n, total, s.block_docs)
            asked: dict = {}
            for row in group.iloc[1:].itertuples():
                postings = Postings(row.heads, row.fronts, row.postings, shard)
                for item in row.items:
                    asked.setdefault(item, []).append((int(row.weight), postings))
            for item, own in asked.items():
                search_shard(own, shard, heaps.setdefault(item, Heap(k)))
        yield from _emptied(heaps)

    def _emptied(heaps: dict) -> Iterator[pd.DataFrame]:
        found = [(item, row[2], -row[0]) for item, heap in heaps.items() for row in heap.rows]
        if found:
            out = pd.DataFrame(found, columns=["item", "doc", "score"])
            yield out.assign(doc=pd.Series([f[1] for f in found], dtype=object))

    heaps = spread(met, "grp", "shard").sortWithinPartitions("grp", "shard", F.col("term").asc_nulls_first()).mapInPandas(run, schema)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return heaps.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(doc_id), "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
                   s: IndexSettings = IndexSettings()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring rows of ``docs`` for each item, equal scores by document.

    Every row of ``docs`` is a document, also one with a repeated or a null id (null comes last among equal scores);
    null and empty texts and texts without a term count for nothing. Rows of ``items`` with one id are one item
    with the terms of all of them; items without an id, a text or a term that a document has get no rows. Terms with a
    weight of zero add nothing. Empty tables give no rows; other columns are not read.
    """
    index = materialise(build_index(docs, doc_id, text, s), "index")
    return search(index, items, k, item_id, text, doc_id, s)


SQL = r"""
WITH words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), sizes AS (
  SELECT rid, doc_id, count(*) AS n FROM words GROUP BY rid, doc_id
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), lengths AS (
  SELECT rid, doc_id, 10 + (90 * n * docs) // total AS m FROM sizes, corpus
), freq AS (
  SELECT rid, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY rid, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM freq, corpus GROUP BY term, docs
), scores AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN freq USING (term) JOIN weights USING (term) JOIN lengths USING (rid) GROUP BY item_id, rid, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) QUALIFY row_number() OVER best <= 10"""
