"""Near-duplicate join of texts by the Jaccard similarity of their word n-grams, along chosen paths.

Texts with the same set of n-grams form one group. Every group has min-hash tokens, and each of several
runs splits the groups recursively: at a node of the recursion tokens are sampled by a hash of the path
so far, and all groups that share a sampled token go on together. Buckets small enough are compared
pair by pair; a bucket that is still large at the last level is compared in blocks, so none is cut.
A pair may meet in several buckets and counts only in the first of them, so that no list of pairs is
ever written: a bucket gives one row for each member that has links. Links are exact: they are counted
from the whole n-gram sets. The number of runs follows from the recall asked for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.functions.skew import spread
from quartermill.llm.common import column_type, text_or_empty, whole_groups
from quartermill.session import materialise

RUN_SHIFT = np.uint64(57)  # the run stands in the upper bits of a path, so up to 64 runs
MAX_RUNS = 64
CHUNK = 1 << 16
STRIP_CELLS = 1 << 22  # cells of the strip of a membership matrix that is held at once


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5
    similarity: float = 0.8
    positions: int = 64  # min-hash tokens of a set
    children: float = 2.0  # tokens sampled at a node, on average
    leaf: int = 1024  # buckets up to this size are compared pair by pair, larger ones in the end in blocks of it
    block_shingles: int = 1 << 21  # n-grams that a block's sets have together, about
    split_gain: float = 0.5  # a split must leave at most this share of a bucket's comparisons
    depth: int = 6
    recall: float = 0.9995  # of pairs at exactly the similarity asked for, in the worst case
    sketch_loss: float = 1e-9  # share of the pairs the recall may lose that sketches may lose

    @property
    def sketch_limit(self) -> int:
        """Positions in which the sketches of a pair must agree to be compared exactly."""
        return self._sketch()[0]

    def _sketch(self) -> tuple[int, float]:
        """The limit, and the share of pairs at exactly the similarity asked for whose sketches agree in fewer positions.

        A byte agrees with the chance of its token, or else by accident.
        """
        same = self.similarity + (1 - self.similarity) / 256
        limit, below = 0, 0.0
        while limit < self.positions:
            more = below + math.comb(self.positions, limit) * same**limit * (1 - same) ** (self.positions - limit)
            if more > self.sketch_loss * (1 - self.recall):
                break
            limit, below = limit + 1, more
        return limit, below

    @property
    def runs(self) -> int:
        """Runs until the recall is reached, if every pair needs all levels.

        A similar pair shares a Poisson number of sampled tokens at a node, with the mean
        ``children * similarity``, and meets at the last level if one line of shared tokens survives.
        What the sketches lose, no run finds again.
        """
        mean, lost = self.children * self.similarity, 0.0
        for _ in range(self.depth):
            lost = math.exp(-mean * (1 - lost))
        below = self._sketch()[1]
        runs = math.ceil(math.log((1 - self.recall - below) / (1 - below)) / math.log(lost))
        if runs > MAX_RUNS:
            raise ValueError(f"these settings need {runs} runs, and a path can name {MAX_RUNS}; sample more children or ask for less recall")
        return runs


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one n-gram of all its words."""
    found = text.encode().split()
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(ids))
    n = len(ids) - width + 1
    total = np.full(n, width, np.uint64)
    for shift, seed in enumerate(_seeds(width, 17)):
        total = total + _mixed(ids[shift:shift + n] ^ seed) * seed
    return np.unique(_mixed(total))


def tokens_of(hashes: np.ndarray, positions: int) -> np.ndarray:
    """Min-hash tokens of a set, 32 bits each."""
    seeds = _seeds(positions, 29)[:, None]
    least = np.full(positions, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK // 8):
        least = np.minimum(least, (hashes[None, at:at + CHUNK // 8] * seeds).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def children_of(paths: np.ndarray, tokens: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Paths of the next level and the places of their parents: for each path the tokens whose hash with it falls below ``share``."""
    places = _mixed(tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(tokens), dtype=np.uint64))
    keys = _mixed(paths[:, None] * np.uint64(0xD6E8FEB86659FD93) + places[None, :])
    parent, place = np.nonzero(keys < np.uint64(min(1.0, share) * (2**64 - 2**11)))
    run = paths[parent] >> RUN_SHIFT << RUN_SHIFT
    return run | (_mixed(keys[parent, place]) >> np.uint64(7)), parent


def _roots(runs: int) -> np.ndarray:
    return np.arange(runs, dtype=np.uint64) << RUN_SHIFT


# Buckets in tasks


def _first_meeting(path: int, paths: list[np.ndarray]) -> np.ndarray:
    """For all pairs of a bucket, whether they share no earlier bucket."""
    n = len(paths)
    earlier = [p[p < path] for p in paths]
    sizes = [len(p) for p in earlier]
    if not sum(sizes):
        return np.ones((n, n), bool)
    names, number, times = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    several = times[number] > 1  # a bucket named once can't be shared
    owner, number = owner[several], np.unique(number[several], return_inverse=True)[1]
    return _shared(owner, number, n) == 0


def _shared(owner: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """How many numbers each two of ``n`` owners share, from a membership matrix that is made strip by strip."""
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    names = int(number[-1]) + 1 if len(number) else 0
    width = max(1, min(names, STRIP_CELLS // n))
    shared, member = np.zeros((n, n), np.float32), np.zeros((n, width), np.float32)
    for start in range(0, names, width):
        low, high = np.searchsorted(number, [start, start + width])
        member[:] = 0
        member[owner[low:high], number[low:high] - start] = 1
        shared += member @ member.T
    return shared


def _candidates(group: pd.DataFrame, limit: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket to compare: similar sketches and sizes, from different blocks, met here first."""
    n = len(group)
    own, i, j = group["own"].to_numpy(), group["i"].iat[0], group["j"].iat[0]
    sizes = group["n_shingles"].to_numpy()
    sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(n, -1)
    if n == 2:
        a, b = group["paths"]
        ok = ((sketch[0] == sketch[1]).sum() >= limit and sizes.min() >= similarity * sizes.max() - 1e-9
              and np.intersect1d(a, b, assume_unique=True)[0] == group["path"].iat[0] and (i == j or own[0] != own[1]))
        return (np.array([0]), np.array([1])) if ok else (np.zeros(0, int), np.zeros(0, int))
    pair = np.zeros((n, n), bool)
    for at in range(n):
        pair[at, at + 1:] = (sketch[at + 1:] == sketch[at]).sum(axis=1) >= limit
    if not pair.any():
        return np.nonzero(pair)
    pair &= np.minimum(sizes[:, None], sizes) >= similarity * np.maximum(sizes[:, None], sizes) - 1e-9
    if i != j:
        pair &= own[:, None] != own
    pair &= _first_meeting(group["path"].iat[0], list(group["paths"]))
    return np.nonzero(pair)


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs have the similarity, from their whole sets."""
    sizes = np.array([len(s) for s in sets])
    if len(a) <= 2 * len(sets):
        both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)])
    else:
        used = np.unique(np.concatenate([a, b]))
        number = np.unique(np.concatenate([sets[x] for x in used]), return_inverse=True)[1].astype(np.int32)
        shared = _shared(np.repeat(np.arange(len(used), dtype=np.int32), sizes[used]), number, len(used))
        both = shared[np.searchsorted(used, a), np.searchsorted(used, b)]
    return both + 1e-9 >= similarity * (sizes[a] + sizes[b] - both)


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


# Steps on Spark

_BUCKET = ["path", "i", "j"]


def sign(df: DataFrame, doc_id: str, text: str, s: JoinSettings) -> DataFrame:
    """``(id, gid, text_key, n_shingles, tokens, paths)`` of each row; without words only id and text key."""
    schema = f"id {column_type(df, doc_id)}, gid binary, text_key binary, n_shingles int, tokens binary, paths array<bigint>"
    share, roots = s.children / s.positions, _roots(s.runs)

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for key, value in zip(batch["text_key"], batch["_text"]):
                hashes = shingles(value, s.words)
                if not len(hashes):
                    made.append((None, key, None, None, None))
                    continue
                tokens = tokens_of(hashes, s.positions)
                made.append((hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), key, len(hashes),
                             tokens.tobytes(), children_of(roots, tokens, share)[0].astype(np.int64)))
            out = pd.DataFrame(made, columns=["gid", "text_key", "n_shingles", "tokens", "paths"])
            out["n_shingles"] = out["n_shingles"].astype("Int32")
            out.insert(0, "id", batch["id"].to_numpy() if batch["id"].dtype != object else list(batch["id"]))
            yield out

    source = df.select(F.col(doc_id).alias("id"), _text_key(text).alias("text_key"), text_or_empty(text).alias("_text"))
    return source.mapInPandas(rows, schema)


def _text_key(text: str):
    return F.unhex(F.md5(text_or_empty(text).cast("binary")))


def leaf_buckets(groups: DataFrame, s: JoinSettings) -> DataFrame:
    """``(path, gid, n, held)``: membership in the buckets that are compared, ``n`` rows and ``held`` n-grams each.

    A bucket above ``leaf`` is split, if that pays: if its members are near copies of each other, nearly
    all of them go on together into every child, and the children would need more comparisons than
    the bucket itself. Such a bucket stays whole and is compared in blocks.
    """
    share = s.children / s.positions

    def expand(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gids, sizes, parents, paths = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for gid, size, own, tokens in zip(batch["gid"], batch["n_shingles"], batch["own"], batch["tokens"]):
                own = np.asarray(own, np.int64)
                found, parent = children_of(own.astype(np.uint64), np.frombuffer(tokens, np.uint32), share)
                gids += [gid] * len(found)
                sizes += [size] * len(found)
                parents.append(own[parent])
                paths.append(found.astype(np.int64))
            yield pd.DataFrame({"path": np.concatenate(paths), "parent": np.concatenate(parents), "gid": gids, "n_shingles": np.array(sizes, np.int32)})

    size = F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("held")
    found = groups.select(F.explode("paths").alias("path"), "gid", "n_shingles")
    counts = found.groupBy("path").agg(*size).filter("n > 1")
    met = materialise(found.drop("n_shingles").join(counts, "path"), "level1")
    leaves, active = [], groups.select("gid", "n_shingles", "tokens")
    for level in range(2, s.depth + 2):
        leaves.append(met.filter(F.col("n") <= s.leaf))
        large = met.filter(F.col("n") > s.leaf)
        if large.isEmpty():
            break
        if level > s.depth:
            leaves.append(large)
            break
        # Only groups in large buckets go on, and with them their tokens.
        own = large.groupBy("gid").agg(F.collect_list("path").alias("own"))
        active = materialise(active.join(own, "gid").select("gid", "n_shingles", "tokens", "own"), f"active{level}")
        below = materialise(active.mapInPandas(expand, "path bigint, parent bigint, gid binary, n_shingles int"), f"below{level}")
        active = active.drop("own")
        counts = below.groupBy("path", "parent").agg(*size).filter("n > 1")
        work = counts.groupBy(F.col("parent").alias("path")).agg(F.sum(F.col("n").cast("double") ** 2).alias("work"))
        sizes = large.groupBy("path").agg(F.first("n").alias("size"))
        pays = F.coalesce("work", F.lit(0.0)) <= s.split_gain * F.col("size").cast("double") ** 2
        parents = materialise(sizes.join(work, "path", "left").select("path", pays.alias("split")), f"parents{level}")
        leaves.append(large.join(parents.filter("NOT split").select("path"), "path", "left_semi"))
        going = counts.join(parents.filter("split").select(F.col("path").alias("parent")), "parent", "left_semi").select("path", "n", "held")
        met = materialise(below.select("path", "gid").join(going, "path"), f"level{level}")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out


def _bucket_rows(members: DataFrame, s: JoinSettings) -> DataFrame:
    """Each group once per bucket, or once per pair of blocks where it is larger than one."""
    one = members.select("gid", "n_shingles", "sketch", F.transform("met", lambda m: m["path"]).alias("paths"), F.explode("met").alias("m"))
    one = one.select("gid", "n_shingles", "sketch", "paths", F.col("m.path").alias("path"),
                     F.ceil(F.greatest(F.col("m.n") / s.leaf, F.col("m.held") / s.block_shingles)).cast("int").alias("blocks"))
    one = one.withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    one = one.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return one.select("path", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "gid",
                      "n_shingles", "sketch", "paths")


def _marked(rows: DataFrame, s: JoinSettings) -> DataFrame:
    """Members of buckets that may have a link there."""
    limit, similarity = s.sketch_limit, s.similarity

    def mark(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for group in whole_groups(batches, _BUCKET):
            if len(group) > 1:
                a, b = _candidates(group, limit, similarity)
                if len(a):
                    part = group.iloc[np.unique(np.concatenate([a, b]))]
                    held.append(part)
                    size += len(part)
            if size > 5000:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    schema = "path bigint, i int, j int, own int, gid binary, n_shingles int, sketch binary, paths array<bigint>"
    return spread(rows, *_BUCKET).sortWithinPartitions(*_BUCKET).mapInPandas(mark, schema)


def _with_hashes(words: int):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="_text").assign(hashes=[shingles(t, words).tobytes() for t in batch["_text"]])

    return rows


def _links(marked: DataFrame, groups: DataFrame, texts: DataFrame, s: JoinSettings) -> DataFrame:
    """``(gid, links, root)``: rows that each member of a bucket is linked to there, and the bucket's smallest linked member."""
    similarity, limit = s.similarity, s.sketch_limit
    # The buckets of a group pass through Python as one string, to be taken apart again behind it.
    bucket = F.concat_ws(":", "path", "i", "j", "own")
    per_group = marked.groupBy("gid").agg(
        F.array_join(F.collect_list(bucket), ",").alias("buckets"), F.first("sketch").alias("sketch"),
        F.first("paths").alias("paths"), F.first("n_shingles").alias("n_shingles"),
    ).join(groups.select("gid", "text_key", "copies"), "gid")
    with_text = texts.join(per_group, "text_key")

    kept = "gid", "copies", "n_shingles", "sketch", "paths"
    hashed = with_text.select(*kept, "buckets", "_text").mapInPandas(_with_hashes(s.words), (
        "gid binary, copies bigint, n_shingles int, sketch binary, paths array<bigint>, buckets string, hashes binary"))
    rows = hashed.select(*kept, "hashes", F.explode(F.split("buckets", ",")).alias("_b")).withColumn("_b", F.split("_b", ":"))
    rows = rows.select(F.col("_b")[0].cast("bigint").alias("path"), *[F.col("_b")[k].cast("int").alias(n) for k, n in ((1, "i"), (2, "j"), (3, "own"))],
                       *kept, "hashes")

    def compare(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for group in whole_groups(batches, _BUCKET):
            if len(group) < 2:
                continue
            group = group.sort_values("gid")
            a, b = _candidates(group, limit, similarity)
            if not len(a):
                continue
            ok = _linked([np.frombuffer(h, np.uint64) for h in group["hashes"]], a, b, similarity)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            copies, gid = group["copies"].to_numpy(), group["gid"].to_numpy()
            links = np.bincount(a, copies[b], len(group)) + np.bincount(b, copies[a], len(group))
            roots = _local_roots(len(group), a, b)
            held += [(gid[x], int(links[x]), gid[roots[x]]) for x in np.flatnonzero(links)]
            if len(held) > 5000:
                yield pd.DataFrame(held, columns=["gid", "links", "root"])
                held = []
        if held:
            yield pd.DataFrame(held, columns=["gid", "links", "root"])

    return spread(rows, *_BUCKET).sortWithinPartitions(*_BUCKET).mapInPandas(compare, "gid binary, links bigint, root binary")


def components(edges: DataFrame) -> DataFrame:
    """``(node, least)``: the smallest node connected with each node that has an edge ``(a, b)``.

    Alternating stars: every node hands the smallest node it sees to its larger, then to its smaller
    neighbours, until nothing changes. Each round is written, which cuts the lineage.
    """
    now = materialise(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        small = near.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        now = materialise(small.distinct(), "edges")
        after = _fingerprint(now)
        if after == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("least"))
        mark = after


def _fingerprint(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first())


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", s: JoinSettings = JoinSettings()) -> DataFrame:
    """``(doc_id, class_id, n_links, stays, text_key)``, one row per row of ``df``.

    ``n_links`` is the number of other rows whose n-gram sets have at least the similarity asked for,
    copies included; ``class_id`` the smallest id of the rows connected by links; ``stays`` marks the row that has it. A text of fewer words
    than an n-gram is one n-gram. A null or empty text, or one of white space only, has no links and
    is a class of its own; rows with a null id take part, but a class has a null id only if all its ids
    are null. Repeated rows are copies of each other. Empty tables give no rows; other columns of
    ``df`` are not read.
    """
    signed = materialise(sign(df, doc_id, text, s), "signed")
    groups = materialise(
        signed.filter("gid IS NOT NULL").groupBy("gid").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("first"),
            F.min("text_key").alias("text_key"),
            F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"), F.first("paths").alias("paths")),
        "groups",
    )
    met = leaf_buckets(groups, s)
    positions = s.positions
    # One byte of each token is a sketch: the lowest of its four.
    sketch = F.concat(*[F.substring("tokens", 4 * p + 1, 1) for p in range(positions)])
    members = met.groupBy("gid").agg(F.collect_list(F.struct("path", "n", "held")).alias("met")).join(
        groups.select("gid", "n_shingles", sketch.alias("sketch")), "gid")
    marked = materialise(_marked(_bucket_rows(members, s), s), "marked")
    texts = df.select(_text_key(text).alias("text_key"), text_or_empty(text).alias("_text"))
    texts = texts.groupBy("text_key").agg(F.first("_text").alias("_text"))
    links = materialise(_links(marked, groups, texts, s), "links")
    least = components(links.select(F.col("gid").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("gid").agg(F.sum("links").alias("links"))
    classes = (
        groups.select("gid", "copies", "first")
        .join(counted, "gid", "left").join(least.withColumnRenamed("node", "gid"), "gid", "left")
        .select("gid", "first", F.coalesce("least", "gid").alias("least"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    smallest = classes.groupBy("least").agg(F.min("first").alias("first"))
    classes = classes.drop("first").join(smallest, "least").select("gid", "first", "n_links")
    alone = F.col("gid").isNull()
    return signed.select("id", "gid", "text_key").join(classes, "gid", "left").select(
        F.col("id").alias(doc_id), F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (alone | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key")))).alias("stays"), "text_key",
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", s: JoinSettings = JoinSettings()) -> DataFrame:
    """Rows of ``df`` such that one of each class stays: the one with its smallest id.

    Exact repeats of that row, id and text, are one row afterwards; texts without words all stay, once
    for each id.
    """
    key = lambda column, digest: F.concat_ws(":", F.coalesce(F.col(column).cast("string"), F.lit("")), F.hex(digest))
    stay = near_duplicates(df, doc_id, text, s).filter("stays").select(key(doc_id, F.col("text_key")).alias("_stay")).distinct()
    rows = df.withColumn("_stay", key(doc_id, _text_key(text)))
    return rows.join(stay, "_stay", "left_semi").dropDuplicates(["_stay"]).select(df.columns)


def sql(words: int = 5, percent: int = 80) -> str:
    """The same classes and links over ``documents`` as one SQL statement that compares sets by shared n-grams."""
    return rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END)) AS s
  FROM texts
), sets AS (
  SELECT s, min(doc_id) AS g, count(*) AS copies, len(s) AS size FROM grams WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT g, size, unnest(s) AS item FROM sets
), pairs AS (
  SELECT a.g AS x, b.g AS y FROM items a JOIN items b ON a.item = b.item AND a.g <> b.g
    AND 100 * least(a.size, b.size) >= {percent} * greatest(a.size, b.size)
  GROUP BY a.g, b.g, a.size, b.size HAVING 100 * count(*) >= {percent} * (a.size + b.size - count(*))
), reach AS (
  SELECT g AS x, g AS y FROM sets
  UNION
  SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y
), classes AS (
  SELECT x AS g, min(y) AS class_id FROM reach GROUP BY x
), links AS (
  SELECT p.x AS g, sum(s.copies) AS n FROM pairs p JOIN sets s ON s.g = p.y GROUP BY p.x
)
SELECT t.doc_id, coalesce(c.class_id, t.doc_id) AS class_id,
       CAST(CASE WHEN s.g IS NULL THEN 0 ELSE coalesce(l.n, 0) + s.copies - 1 END AS BIGINT) AS n_links
FROM grams t LEFT JOIN sets s ON s.s = t.s LEFT JOIN classes c ON c.g = s.g LEFT JOIN links l ON l.g = s.g"""
