"""Ranked search, the prefix trie and files of token ids."""

import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quartermill.llm import lexical, prefix_trie, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# ---- ranked search


def plain_ranking(docs, items, k):
    """Scores of all rows, term by term, as the score is defined."""
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(doc, cut(text)) for doc, text in docs]
    found = [(doc, words) for doc, words in found if words]
    n, total = len(found), sum(len(words) for _, words in found)
    df = {}
    for _, words in found:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(cut(text))
    out = set()
    for item, terms in asked.items():
        scored = []
        for doc, words in found:
            m = 10 + 90 * len(words) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * words.count(t) // (1000 * words.count(t) + 8 * m)) for t in terms if t in words)
            if score:
                scored.append((-score, doc is None, doc or 0, doc))
        out |= {(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored)[:k], 1)}
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "straße", "漢字", "İx", "don't", "a-b"]
    weights = [1 / (1 + i) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(n)]


@pytest.mark.parametrize("settings", [lexical.IndexSettings(), lexical.IndexSettings(block_docs=8, shard_docs=50, group_items=3), lexical.IndexSettings(block_docs=1, shard_terms=30)])
def test_best_documents_equal_scoring_all(spark, settings):
    docs = random_docs(3, 400)
    docs += docs[:3] + [(None, docs[5][1]), (None, docs[5][1]), (7000, None), (7001, ""), (7002, "!? .")]
    items = [(i, text) for i, text in random_docs(9, 12)] + [(50, None), (51, ""), (52, "nowhere else"), (None, "w1 w2"), (3, "w40 w41"), (3, "w40 w41")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"score": F.lit("x"), "shard": F.lit(1), "rank": F.lit(2)}).repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"score": F.lit("x"), "grp": F.lit(1)})
    got = lexical.rank_documents(df, asked, 10, s=settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == plain_ranking(docs, items, 10)


def test_search_of_empty_tables_and_other_id_types(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "X")], "item_id string, text string")
    assert [(r["doc_id"], r["rank"]) for r in lexical.rank_documents(docs, items).orderBy("rank").collect()] == [("a", 1), ("b", 2)]
    assert lexical.rank_documents(docs.limit(0), items).count() == lexical.rank_documents(docs, items.limit(0)).count() == 0


def shard_of(docs, s):
    shard = lexical._Shard()
    for doc, text in docs:
        shard.add(doc, text)
    rows = shard.rows(0, s, lexical.pa.int64()).to_pylist()
    n, total = rows[0]["size"], rows[0]["total"]
    documents = lexical.Documents(np.array(rows[0]["ids"]), rows[0]["lengths"], n, total, s.block_docs)
    return documents, {r["term"]: lexical.Postings(r["heads"], r["fronts"], r["postings"], documents) for r in rows[1:]}


def test_block_maxima_are_exact_and_spare_decompression():
    s = lexical.IndexSettings(block_docs=16)
    rng = random.Random(1)
    docs = [(i, " ".join(["common"] * rng.randint(1, 3) + ["rare"] * (rng.random() < 0.02) + [f"x{rng.randint(0, 99)}"] * rng.randint(1, 9))) for i in range(2000)]
    documents, lists = shard_of(docs, s)
    for postings in lists.values():
        for block in postings.place:
            assert postings.most[block] == postings.block(block)[1].max()
        postings.opened.clear()
    heap = lexical.Heap(5)
    looked = lexical.search_shard([(3000, lists[b"rare"]), (1, lists[b"common"])], documents, heap)
    assert len(heap.rows) == 5 and looked < len(lists[b"rare"].place) + len(lists[b"common"].place) // 2
    assert len(lists[b"common"].opened) < len(lists[b"common"].place) // 4  # candidates were rejected before


def test_numbers_survive_packing():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 5, 2**40])
    data, ends = lexical.pack(values)
    assert (lexical.unpack(data) == values).all() and ends[-1] == len(data)
    assert list(lexical.terms_of("Ab" * lexical.PIECE + " é1-x"))[0][0] == b"ab" * lexical.PIECE


# ---- prefix trie


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, hashlib.md5(role.encode()).hexdigest(), hashlib.md5(text.encode()).hexdigest())
            convs.setdefault(conv, []).append((key, (role, text)))
    convs = {c: [t for _, t in sorted(own)] for c, own in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    nodes = {}
    for c, own in built.items():
        for d in range(len(own) + 1):
            nodes.setdefault(tuple(own[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(path))))
        out.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def random_turns(seed):
    rng = random.Random(seed)
    rows = []
    for c in list(range(45)) + [60, 61, 67, 100, 1000]:
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d e f"])) for t in range(rng.choice([1, 1, 2, 3, 4, 7, 30]))]
    rows += [(c, t, "user", f"same {t % 3}") for c in (200, 201, 202, 203) for t in range(25)]
    rows += [(5, None, None, "first"), (5, 0, "x", None), (5, 0, "x", None), (None, 0, "user", "nobody"), (-3, 0, "user", "below zero"), (303, 0, "user", "short")]
    return rows


@pytest.mark.parametrize("height", [1, 3, 8, 64])
def test_trie_equals_plain_prefixes(spark, height):
    rows = random_turns(height)
    df = spark.createDataFrame(rows, TURNS).withColumns({"node": F.lit("x"), "depth": F.lit(1), "place": F.lit(2)})
    got = prefix_trie.family_trie(df, s=prefix_trie.TrieSettings(height=height))
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == plain_trie(rows)


def test_trie_of_no_conversations_and_of_one_without_turns(spark):
    df = spark.createDataFrame([], TURNS)
    assert prefix_trie.family_trie(df).count() == 0
    rows = [(c, 0, "user", "hi") for c in range(21, 40)]  # the first of the family is missing, so some lose their only turn
    assert {tuple(r) for r in prefix_trie.family_trie(spark.createDataFrame(rows, TURNS)).collect()} == plain_trie(rows)


def test_digest_of_many_ends_is_joined_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(20 * c, 0, "user", "one and only") for c in range(500)]
    got = {r["depth"]: r for r in prefix_trie.family_trie(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[1]["n_convs"] == 500 and got[1]["ends_sha256"] == hashlib.sha256(",".join(str(20 * c) for c in range(500)).encode()).hexdigest()


# ---- files of token ids


@pytest.mark.parametrize("percentile", [1, 50, 90, 100])
def test_blocks_give_the_ids_back(percentile):
    rng = np.random.default_rng(percentile)
    cases = [np.zeros(0), np.array([2**32 - 1, 0, 7]), np.full(600, 2**32 - 1), rng.integers(0, 2**32, 1000), rng.integers(0, 49408, 5000),
             np.where(rng.random(3000) < 0.05, rng.integers(0, 2**32, 3000), rng.integers(500, 520, 3000)), np.arange(257) * 2**24]
    for width in range(33):
        cases.append(rng.integers(0, 2**width, 300))
    for ids in cases:
        ids = ids.astype(np.uint32)
        data, starts = token_files.encode_blocks(ids, percentile)
        assert len(starts) == -(-len(ids) // token_files.BLOCK)
        assert (token_files.decode_blocks(data, starts) == ids).all() if len(ids) else not len(data)


def test_outliers_are_exceptions_and_cost_little():
    ids = np.random.default_rng(2).integers(0, 16, 256).astype(np.uint32)
    ids[[3, 99]] = 2**31
    data, _ = token_files.encode_blocks(ids)
    assert len(data) == token_files.HEADER + 256 * 4 // 8 + 2 * 5


def test_any_range_of_a_file_is_read_from_its_blocks():
    rng = np.random.default_rng(1)
    docs = [(None if i == 0 else f"d{i}é", rng.integers(0, 50000, rng.integers(0, 900)).astype(np.uint32)) for i in range(50)]
    writer = token_files.FileWriter(4)
    rows = [row for name, ids in docs for row in writer.add(name, ids)] + list(writer.close())
    content = b"".join(row + b"\n" for row in rows)
    file, whole = token_files.FileReader(content), np.concatenate([ids for _, ids in docs])
    assert (file.part, file.total, file.names) == (4, len(whole), [name for name, _ in docs])
    for start, end in [(0, 0), (0, 1), (255, 257), (1000, 5000), (len(whole) - 3, len(whole))]:
        assert (file.ids(start, end) == whole[start:end]).all()
    back = list(file.by_document())
    assert all((ids == want).all() and name == known for (name, _, ids), (known, want) in zip(back, docs))
    with pytest.raises(ValueError):
        token_files.FileReader(content[:-9] + b"PFORIDS2\n")


def odd_texts(n):
    rng = random.Random(5)
    signs = list("abAB09 \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　.,'!<|>éÉİßΣςẞ̸́ﬁ①Ⅳ한가漢😀ñͅ") + ["<|endoftext|>", "<|startoftext|>", "'re", " 0 ", "don't", "Word.", "Mañana, "]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_equal_those_of_the_library():
    with open(WORD_BPE, "rb") as file:
        encoder = token_files.Encoder(file.read())
    assert encoder.parted
    library = Tokenizer.from_file(WORD_BPE)
    encoder.parts.size = 500  # so that much is forgotten
    texts = odd_texts(4000) + ["x" * 3_000_000 + " end.", " ".join(odd_texts(300))]
    for got, want in zip(encoder.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids


def test_tokenizers_that_keep_white_space_are_left_to_the_library():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        encoder = token_files.Encoder(file.read())
    assert not encoder.parted
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts(50)
    assert [e.tolist() for e in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_files_give_every_document_in_order(spark, tmp_path):
    texts = odd_texts(300)
    rows = [(3 * (i % 150) - 40, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (7000, None), (7001, ""), (5, texts[0]), (5, texts[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"part": F.lit("x"), "name": F.lit(1), "ids": F.lit(2), "start": F.lit(3)})
    got = token_files.round_trip(df.repartition(5), WORD_BPE, str(tmp_path / "files"), end_id=2, ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(WORD_BPE)
    known = {}
    for doc, text in rows:
        known.setdefault(doc, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert len(got) == len(rows) and keys == sorted(keys)
    at = 0
    for r in got:
        assert r["start"] == at and list(r["ids"]) in known[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        known[r["doc_id"]].remove(list(r["ids"]))
        at += r["n_tokens"]
    assert token_files.round_trip(df.limit(0), WORD_BPE, str(tmp_path / "none"), end_id=2).count() == 0


def test_ids_of_other_types_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "z"), ("B", "w")], "doc_id string, text string")
    got = token_files.round_trip(df, WORD_BPE, str(tmp_path / "files"), ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, "B", "a", "b"] and json.dumps([len(r["ids"]) for r in got]) == "[1, 1, 1, 1]"
