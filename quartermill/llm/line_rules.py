"""Line-first cleaning: rules judge each line, failed lines go, documents that lose too much go too."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import column_type, map_texts, text_or_empty

# Marks and phrases the rules look for.
SYMBOLS = "#*$%&|<>"
SENTENCE_MARKS = ".!?…。"
SEPARATORS = "|»›•·"
MENU_WORDS = (
    "home", "about", "contact", "login", "logout", "register", "search", "menu", "next", "previous", "back", "top",
    "share", "print", "subscribe", "sitemap", "faq", "help",
)
BOILERPLATE = (
    "all rights reserved", "licensed under", "copyright ©", "terms of service", "terms of use", "privacy policy",
    "cookie policy", "uses cookies", "enable javascript", "lorem ipsum", "click here", "read more",
)
_BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; all are inclusive bounds of what still passes."""

    min_words: int = 50
    max_repeated_percent: int = 50
    unmarked_words: int = 7  # a line of more words needs a sentence mark
    symbols_per_100_words: int = 50  # and at most so many symbols
    exclamations_per_100_words: int = 50
    separators: int = 2  # more of them are navigation, unless ...
    words_per_separator: int = 4  # ... there are more words than this for each
    max_lost_percent: int = 50
    phrases: Sequence[str] = field(default=BOILERPLATE)
    menu_words: Sequence[str] = field(default=MENU_WORDS)


def judge_line(line: str, rules: LineRules) -> str | None:
    """The first rule that a line with words fails: punctuation, navigation or boilerplate."""
    n = len(line.encode().split())
    separators = sum(map(line.count, SEPARATORS))
    if separators > rules.separators and n <= rules.words_per_separator * separators:
        return "navigation"
    if n > rules.unmarked_words and not any(mark in line for mark in SENTENCE_MARKS):
        return "punctuation"
    if 100 * sum(map(line.count, SYMBOLS)) > rules.symbols_per_100_words * n:
        return "punctuation"
    if 100 * line.count("!") > rules.exclamations_per_100_words * n and line.count("!") > 1:
        return "punctuation"
    lowered = line.lower()
    words = lowered.split()
    if len(words) > 1 and 2 * sum(w in rules.menu_words for w in words) > len(words):
        return "navigation"
    if any(phrase in lowered for phrase in rules.phrases):
        return "boilerplate"
    return None


def _word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, _BLANKS))


def repeated_words(words: Sequence[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    size = len(numbers)
    if size < 2_000_000:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # the product would overflow, so pairs are numbered first
        _, pairs = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)
        keys = pairs * size + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def clean_text(text: str, rules: LineRules) -> dict:
    """Base counts, the text without failed lines, and the verdict of one document."""
    words = text.encode().split()
    n_words, word_chars = len(words), _word_chars(text)
    seen: set[str] = set()
    left, lost, lost_lines, duplicates = [], 0, 0, 0
    for line in text.split("\n"):
        if not line.strip(_BLANKS):
            left.append(line)
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        if again or judge_line(line, rules):
            lost += _word_chars(line)
            lost_lines += 1
        else:
            left.append(line)
    repeated = repeated_words(words)
    failed = n_words < rules.min_words or 100 * repeated > rules.max_repeated_percent * n_words
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": duplicates, "n_repeat_words": repeated, "base_failed": failed,
        "n_failed_lines": lost_lines, "lost_chars": lost,
        "kept": not failed and 100 * lost <= rules.max_lost_percent * word_chars,
        "clean_text": "\n".join(left).strip(_BLANKS) if lost_lines else text,
    }


#: Type of each output that ``clean`` can add.
OUTPUTS = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
    "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean", "n_failed_lines": "bigint",
    "lost_chars": "bigint", "clean_text": "string",
}


def clean(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: LineRules = LineRules(),
          outputs: Sequence[str] = tuple(OUTPUTS)) -> DataFrame:
    """Judge every line of every whole text and each document by what its lines leave.

    One row per row of ``df``: the columns ``keep`` and ``outputs``. A line fails if it repeats an
    earlier line or by ``judge_line``; ``kept`` is false for documents that fail the base rules (too
    few words, too many in repeated windows) or lose more than ``max_lost_percent`` of their word
    characters. A null or empty text has no words and is not kept. Repeated rows are judged alike and
    all returned; an empty table gives none; columns outside ``keep`` are not read.
    """
    clash = set(keep) & set(outputs)
    if clash:
        raise ValueError(f"output names in keep: {sorted(clash)}")
    keep, outputs = list(keep), list(outputs)
    schema = ", ".join([f"`{c}` {column_type(df, c)}" for c in keep] + [f"{o} {OUTPUTS[o]}" for o in outputs])

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        judged = [clean_text(value, rules) for value in batch["_text"]]
        made = {o: [row[o] for row in judged] for o in outputs}
        return pd.DataFrame({**{c: batch[c] for c in keep}, **made}, columns=[*keep, *outputs])

    return map_texts(df.select(*[F.col(c) for c in keep], text_or_empty(text).alias("_text")), schema, rows)


def cleaned(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The rows of ``df`` that ``clean`` keeps, with the cleaned text in place of the text.

    Only the texts go to Python, and only kept ones come back. Nulls, repeats and empty tables as in ``clean``.
    """

    @F.pandas_udf("string")
    def without_failed_lines(texts: pd.Series) -> pd.Series:
        judged = (clean_text(value, rules) for value in texts)
        return pd.Series([row["clean_text"] if row["kept"] else None for row in judged], dtype=object)

    # Not deterministic, so that the filter is not moved below and the texts are not judged twice.
    return df.withColumn(text, without_failed_lines.asNondeterministic()(text_or_empty(text))).filter(F.col(text).isNotNull())


def sql(rules: LineRules = LineRules()) -> str:
    """The same verdicts over ``documents`` as one SQL statement; row numbers stand in for the document."""
    quoted = ", ".join(f"'{p}'" for p in rules.phrases)
    menu = ", ".join(f"'{w}'" for w in rules.menu_words)
    count = lambda column, marks: f"length({column}) - length(translate({column}, '{marks}', ''))"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS words3
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), again AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, words3) > 1
), repeated AS (
  SELECT rid, count(DISTINCT i + shift) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS s(shift) GROUP BY rid
), lines AS (
  SELECT rid, pos, line, lower(line) AS lowered, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         {count('line', SEPARATORS)} AS separators, {count('line', SYMBOLS)} AS symbols, {count('line', '!')} AS shouts,
         row_number() OVER (PARTITION BY rid, line ORDER BY pos) > 1 AS again
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
  SELECT rid, chars, again, again
    OR (separators > {rules.separators} AND n <= {rules.words_per_separator} * separators)
    OR (n > {rules.unmarked_words} AND NOT regexp_matches(line, '[{SENTENCE_MARKS}]'))
    OR 100 * symbols > {rules.symbols_per_100_words} * n
    OR (100 * shouts > {rules.exclamations_per_100_words} * n AND shouts > 1)
    OR (len(regexp_extract_all(lowered, '\S+')) > 1 AND 2 * len(list_filter(regexp_extract_all(lowered, '\S+'), lambda x: x IN ({menu})))
        > len(regexp_extract_all(lowered, '\S+')))
    OR len(list_filter([{quoted}], lambda p: contains(lowered, p))) > 0 AS failed
  FROM lines
), per_doc AS (
  SELECT rid, count(*) FILTER (WHERE again) AS n_dup_lines, count(*) FILTER (WHERE failed) AS n_failed_lines,
         coalesce(sum(chars) FILTER (WHERE failed), 0) AS lost
  FROM judged GROUP BY rid
), counted AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
         CAST({count('d.text', SYMBOLS)} AS BIGINT) AS n_symbols, coalesce(p.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words, coalesce(p.n_failed_lines, 0) AS n_failed_lines,
         CAST(coalesce(p.lost, 0) AS BIGINT) AS lost_chars
  FROM docs d JOIN words w USING (rid) LEFT JOIN repeated r USING (rid) LEFT JOIN per_doc p USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated_percent} * n_words AS base_failed,
       NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated_percent} * n_words)
         AND 100 * lost_chars <= {rules.max_lost_percent} * word_chars AS kept,
       n_failed_lines, lost_chars
FROM counted"""
