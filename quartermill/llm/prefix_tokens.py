"""Token counts of every prefix of a text, for byte-level pair-merge tokenizers.

A sequence of tokens is what the tokenizer makes of its bytes exactly if every two neighbours are what
it makes of theirs. So the encoding of a prefix ends in the one token whose left neighbour is the last
token of a shorter prefix and which fits it. Going from left to right, the last token and the count
of every prefix follow from those of shorter ones. The counts answer how many tokens a cut text has
and where a budget is spent without encoding again.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Sequence
from operator import sub

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import Memo, column_type, kept_for_worker, map_texts, text_or_empty

# The pattern by which byte-level tokenizers of this kind split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Contractions whose shorter prefixes are split differently from the whole.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
#: Remembered words and chunks per worker (and as many older ones).
MEMO = 250_000


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space"):
            raise ValueError("only byte-level pair-merge tokenizers without a prefix space are supported")
        if spec["normalizer"] is not None:
            raise ValueError("tokenizers with a normalizer are not supported")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: Tokens by rank: single bytes first, then one for each merge, in order.
        self.token = {bytes([b]): b for b in range(256)}
        self.joined: dict[tuple[int, int], int] = {}
        self.split: list[tuple[int, int]] = [(b, b) for b in range(256)]
        for a, b in pairs:
            left, right = self.token[raw(a)], self.token[raw(b)]
            if raw(a + b) in self.token:
                raise ValueError("a token is made by two merges")
            self.joined[left, right] = self.token[raw(a + b)] = len(self.split)
            self.split.append((left, right))
        #: Every start of a token, with the token itself or -1.
        self.starts = {t[:i]: -1 for t in self.token for i in range(1, len(t))} | self.token
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(SPLIT)
        self.runs = regex.compile(r"\p{White_Space}{2}")
        self.blank = regex.compile(r"\p{White_Space}+")
        self.fits: dict[tuple[int, int], bool] = {}
        self.words = Memo(self._changes, MEMO)
        self.chunks = Memo(self._chunk, MEMO)

    def _judge(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side: undo merges around their border, latest
        first, and see whether one across it would have come earlier."""
        joined, split, limit = self.joined, self.split, len(self.split)
        while True:
            if joined.get((left, right), limit) < limit:
                return False
            if left > right and left >= 256:
                limit, left = left, split[left][1]
            elif right >= 256:
                limit, right = right + 1, split[right][0]
            elif left >= 256:
                limit, left = left, split[left][1]
            else:
                return True

    def prefixes(self, data: bytes) -> list[int]:
        """Tokens in every non-empty prefix of the bytes of one word."""
        n, starts, fits = len(data), self.starts.get, self.fits
        last, counts = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            before, count = last[start], counts[start] + 1
            for end in range(start + 1, n + 1):
                found = starts(data[start:end])
                if found is None:
                    break
                if found >= 0 and last[end] < 0:
                    if start:
                        pair = before, found
                        fit = fits.get(pair)
                        if fit is None:
                            fit = fits[pair] = self._judge(before, found)
                        if not fit:
                            continue
                    last[end], counts[end] = found, count
        return counts[1:]

    def word_counts(self, word: str) -> list[int]:
        counts = self.prefixes(word.encode())
        if word in LONG_CONTRACTIONS:  # cut after two letters, it is an apostrophe and a letter
            counts[1] = 2
        return counts

    def _changes(self, word: str) -> bytes:
        """Change of the count at each byte of a word."""
        counts = self.word_counts(word)
        return array("b", map(sub, counts, [0, *counts])).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The same for a space and what stands up to the next one."""
        return b"".join(map(self.words.__getitem__, self.pattern.findall(" " + chunk)))

    def _piece_counts(self, text: str) -> np.ndarray:
        """Counts at every byte of a text without special strings."""
        if len(self.fits) > 4 * MEMO:
            self.fits.clear()
        if not self.runs.search(text):  # single spaces begin words, so what stands between them is independent
            first, *rest = text.split(" ")
            changes = [*map(self.words.__getitem__, self.pattern.findall(first)), *map(self.chunks.__getitem__, rest)]
            return np.cumsum(np.frombuffer(b"".join(changes), np.int8), dtype=np.int32)
        words = self.pattern.findall(text)
        counts = np.cumsum(np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int8), dtype=np.int32)
        self._spaces(words, counts)
        return counts

    def _spaces(self, words: list[str], counts: np.ndarray) -> None:
        """A prefix that ends with a run of white space has the run as one word; the text may split off its last space."""
        at, before, blank = 0, "", self.blank.fullmatch
        for word in words:
            if blank(before) and blank(word[0]):
                rest = word if blank(word) else word[0]
                start = at - len(before.encode())
                base = counts[start - 1] if start else 0
                counts[at + len(rest.encode()) - 1] = base + self.prefixes((before + rest).encode())[-1]
            at += len(word.encode())
            before = word

    def counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix: entry ``i`` holds for the first ``i`` UTF-8 bytes, where a character ends there."""
        if self.special is None or not self.special.search(text):
            return np.concatenate([[0], self._piece_counts(text)])
        parts, at, total = [np.zeros(1, np.int64)], 0, 0
        for found in self.special.finditer(text):
            plain = text[at:found.start()]
            own = self._piece_counts(plain) + total
            parts.append(own)
            tail = "".join(self.pattern.findall(plain)[-1:])
            base = total + (int(own[-1]) - total - self.word_counts(tail)[-1] if tail else 0)
            inside = [base + self._piece_counts(tail + found[0][:k])[-1] for k in range(1, len(found[0]))]
            total = int(own[-1] if len(own) else total) + 1
            parts.append(np.array([*inside, total], np.int64))
            at = found.end()
        parts.append(self._piece_counts(text[at:]) + total)
        return np.concatenate(parts)

    def total(self, text: str) -> int:
        return int(self.counts(text)[-1])


def fitting_bytes(counts: np.ndarray, data: bytes, budget: int) -> int:
    """Length in bytes of the longest prefix, cut between characters, of at most ``budget`` tokens."""
    codes = np.frombuffer(data, np.uint8)
    cut = np.ones(len(data) + 1, bool)
    cut[:-1] = codes & 0xC0 != 0x80
    return int(np.flatnonzero((counts <= budget) & cut)[-1])


#: Type of each output that ``count_tokens`` can add.
OUTPUTS = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean", "bytes_in_limit": "bigint",
           "prefix_counts": "array<int>"}


def count_tokens(df: DataFrame, tokenizer: str, limit: int, text: str = "text", keep: Sequence[str] = ("doc_id",),
                 outputs: Sequence[str] = ("n_bytes", "n_tokens", "over_limit", "bytes_in_limit")) -> DataFrame:
    """Token counts of every whole text from the counts of all its prefixes.

    One row per row of ``df``: the columns ``keep`` and ``outputs``, which are the UTF-8 bytes, the
    tokens, whether they are more than ``limit``, the bytes of the longest prefix within ``limit``, and
    the counts themselves (entry ``i``: tokens of the first ``i`` bytes; true where a character ends).
    Special strings inside a text count as their token, as the library does by default. A null or empty
    text has no bytes and no tokens. Repeated rows give repeated rows; other columns are not read.
    The tokenizer file is read on the driver and broadcast: its size is that of one vocabulary.
    """
    clash = set(keep) & set(outputs)
    if clash:
        raise ValueError(f"output names in keep: {sorted(clash)}")
    with open(tokenizer, "rb") as file:
        data = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(data), ("prefixes", hashlib.sha256(data).hexdigest())
    keep, outputs = list(keep), list(outputs)
    schema = ", ".join([f"`{c}` {column_type(df, c)}" for c in keep] + [f"{o} {OUTPUTS[o]}" for o in outputs])

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        counter = kept_for_worker(key, lambda: PrefixCounter(shared.value))
        made: dict[str, list] = {o: [] for o in outputs}
        for value in batch["_text"]:
            counts, raw = counter.counts(value), value.encode()
            row = {"n_bytes": len(raw), "n_tokens": int(counts[-1]), "over_limit": bool(counts[-1] > limit)}
            if "bytes_in_limit" in made:
                row["bytes_in_limit"] = fitting_bytes(counts, raw, limit) if counts.max() > limit else len(raw)
            if "prefix_counts" in made:
                row["prefix_counts"] = counts.astype(np.int32)
            for name in outputs:
                made[name].append(row[name])
        return pd.DataFrame({**{c: batch[c] for c in keep}, **made}, columns=[*keep, *outputs])

    return map_texts(df.select(*[F.col(c) for c in keep], text_or_empty(text).alias("_text")), schema, rows)
