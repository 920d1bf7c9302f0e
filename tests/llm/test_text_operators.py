"""Piece codec, prefix token counts, line rules and quality trees."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quartermill.llm import line_rules, pieces, prefix_tokens, quality, queries

SF = "/root/testdata/sf0.001"
PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [*"\x1c\x85​\xa0²½Ⅷab  \n\n\t'sreve llAé漢😀▁ <|>/0123 .,!?́\x00", "<|endoftext|>", "</s>", "<s>", "'re", "'ve", " 're", "\r\n", "▁▁", "<0x0A>"]
SCHEMA = "doc_id bigint, text string, ids string, _text int, n_tokens string, score string, kept string"


def random_texts(n, longest=30):
    rng = random.Random(1)
    made = ["".join(rng.choices(LETTERS, k=rng.randint(0, longest))) for _ in range(n)]
    return made + ["", " ", "  ", "\n", "▁", "a" * 300, " " * 100 + "x", "é" * 100, "  x", " \nx", "x \n"]


def odd_rows(spark):
    """Nulls, empties, repeats, a very long text, and extra columns named like outputs."""
    words = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, "One text. And more."), (1, "One text. And more."), (2, None), (3, ""), (None, "no id here"), (4, words), (5, " \n\t ")]
    return spark.createDataFrame([(*r, "x", 1, None, "y", "z") for r in rows], SCHEMA), [r[1] or "" for r in rows]


@pytest.fixture(scope="module")
def codec():
    with open(PIECES, "rb") as file:
        return pieces.load(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def counter():
    with open(BYTES, "rb") as file:
        return prefix_tokens.PrefixCounter(file.read())


def test_ids_spans_and_decoding_equal_the_library(codec, library):
    for text in random_texts(1500):
        ids, begins, ends = codec.encode(text)
        want = library.encode(text, add_eos=True)
        assert ids.tolist() == want
        assert codec.decode(want) == library.decode(want)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins[:-1].tolist(), ends[:-1].tolist())) == spans
        assert begins[-1] == ends[-1] == len(text.encode())


def test_own_merging_equals_the_library(codec, library, monkeypatch):
    monkeypatch.setattr(codec, "library", None)
    for text in [*random_texts(800), "unbelievable " * 30 + "incomprehensibilities" * 9]:
        assert codec.encode(text)[0].tolist() == library.encode(text, add_eos=True)


def test_normalisation_through_a_compiled_map(codec):
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = dict(pieces._fields(rule.serialized_normalizer_spec()))
    model = pieces.load(open(PIECES, "rb").read())
    model.map, model.plain = pieces.CharacterMap(spec[2]), False
    model.dummy_prefix, model.strip_spaces, model.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    for text in [*random_texts(800), "ﬁ１２Ａ　ｂ ㌔ é", " a  b  "]:
        got, origin = model.normalise(text)
        want, offsets = rule.normalize(text, with_offsets=True)
        assert got == want
        starts = np.cumsum([0, *[len(c.encode()) for c in got]])
        assert [len(text.encode()[: origin[s]].decode()) for s in starts] == list(offsets)


def test_encode_covers_odd_rows(spark, library):
    df, texts = odd_rows(spark)
    got = pieces.encode(df, PIECES, keep=["doc_id"], outputs=["ids", "begins", "ends", "decoded", "span_bytes"]).collect()
    assert [r["doc_id"] for r in got] == [1, 1, 2, 3, None, 4, 5]
    for row, text in zip(got, texts):
        assert row["ids"] == library.encode(text, add_eos=True)
        assert row["decoded"] == library.decode(row["ids"]) == text
        assert row["span_bytes"] == len(text.encode())
    assert pieces.encode(df.limit(0), PIECES).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(df, PIECES, keep=["ids"], outputs=["ids"])


def test_op2_equals_the_library_on_the_given_documents(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op2_piece_codec(spark, SF).collect():
        ids = library.encode(texts[row["doc_id"]], add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_every_prefix_count_equals_the_library(counter):
    tokenizer = Tokenizer.from_file(BYTES)
    size = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    for text in [*random_texts(250), "it's we're they'll  I've\n\n x", "<|endoftext|> <|endoftext|>"]:
        counts = counter.counts(text)
        for end in range(len(text) + 1):
            assert counts[len(text[:end].encode())] == size(text[:end]), (text, end)


def test_totals_and_budgets(spark, counter):
    tokenizer = Tokenizer.from_file(BYTES)
    df, texts = odd_rows(spark)
    got = prefix_tokens.count_tokens(df, BYTES, limit=3, keep=["doc_id"], outputs=[*prefix_tokens.OUTPUTS]).collect()
    for row, text in zip(got, texts):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (row["n_tokens"], row["n_bytes"], row["over_limit"]) == (n, len(text.encode()), n > 3)
        cut = text.encode()[: row["bytes_in_limit"]].decode()
        assert len(tokenizer.encode(cut, add_special_tokens=False).ids) <= 3
        assert len(row["prefix_counts"]) == len(text.encode()) + 1
    assert prefix_tokens.count_tokens(df.limit(0), BYTES, 3).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op9_prefix_tokens(spark, SF).collect():
        assert row["n_tokens"] == len(tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids)


def plain_repeats(words):
    found = {}
    for i in range(len(words) - 2):
        found.setdefault(tuple(words[i:i + 3]), []).append(i)
    return len({i + k for places in found.values() if len(places) > 1 for i in places for k in range(3)})


def test_repeated_words_equal_a_plain_count():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        assert line_rules.repeated_words(words) == plain_repeats(words)


@pytest.mark.parametrize(("line", "rule"), [
    ("A plain sentence, with an end.", None), ("Short title", None), ("one | two | three | four", "navigation"), ("Home About Contact", "navigation"),
    ("eight words that go on and on forever", "punctuation"), ("bad*** worse&&& worst###.", "punctuation"), ("WHAT!! IS!! THIS!!", "punctuation"),
    ("All rights reserved.", "boilerplate"), ("Wow! Really!", "punctuation"), ("Stop! He turned around and went home again.", None),
])
def test_line_verdicts(line, rule):
    assert line_rules.judge_line(line, line_rules.LineRules()) == rule


def test_clean_covers_odd_rows_and_removes_lines(spark):
    body = "\n".join(f"Sentence{i} number{i} tells{i} one{i} story{i} of its{i} own{i}." for i in range(12))
    df = spark.createDataFrame(
        [(1, body + "\nAll rights reserved.\n" + body.split("\n")[0]), (2, None), (3, ""), (None, body), (4, "a | b | c | d | e\n" * 40), (5, body), (5, body)],
        "doc_id bigint, text string").withColumns({"kept": F.lit("x"), "_text": F.lit(1)})
    got = line_rules.clean(df, keep=["doc_id"]).collect()
    assert [r["kept"] for r in got] == [True, False, False, True, False, True, True]
    assert got[0]["clean_text"] == body and got[0]["n_failed_lines"] == 2 and got[0]["n_dup_lines"] == 1
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and got[1]["clean_text"] == ""
    assert line_rules.clean(df.limit(0)).count() == 0


def test_flat_trees_learn_and_walk_like_single_steps():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = quality.fit(x, y, quality.BoostingSettings(rounds=30))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    for row in x[:20]:
        margin = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            margin += trees.value[node]
        assert margin == pytest.approx(trees.margin(row[None])[0])
    constant = quality.fit(np.zeros((0, 4)), np.zeros(0))
    assert constant.score(np.zeros((2, 4))).tolist() == [0.5, 0.5]


def test_scores_cover_odd_rows_and_missing_labels(spark):
    df, _ = odd_rows(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7)], "doc_id bigint, quality int")
    trees = quality.train(df, labels)
    got = quality.score(df.drop("score"), trees, keep=["doc_id", "kept"]).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert got[0]["score"] == got[1]["score"] and got[2]["score"] == got[3]["score"]
    assert quality.score(df.limit(0), quality.train(df.limit(0), labels.limit(0)), keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        quality.score(df, trees, keep=["score"])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op1_quality_trees(spark, sf)
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    want = scored.select((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("w"), "held_out")
    assert want.filter("w <> held_out").count() == 0
