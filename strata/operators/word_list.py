"""Listed words in texts, the list being a table of any size.

``functions.text.flag_word_hits`` tests one word after the other, which suits a
list of a few dozen.  Here the text is passed over once, whatever the list holds:

* substrings of a list of up to ``PATTERN_BYTES``, which is measured: one pattern that
  branches on one character after the other gives the longest listed word at every place of a
  text; the listed words that a found word starts with are found with it (a small table).
  Where every listed word is a run of letters and digits, it can only lie within such a run of
  a text, so each distinct run of a text is passed over once.  Rows are dealt out evenly before,
  however few row groups hold them;
* substrings of a longer list: the text is cut into short pieces that overlap by the
  longest word; every place of a piece yields an anchor (its next 4 characters, and its next
  2 and 1 where the list has such short words), anchors meet the words that start
  with them in a sort-merge join, whose hot anchors AQE splits, and the pieces that meet
  one are searched for the word;
* words: the letter-and-digit runs of a text meet the list in a join.

All count the distinct words of a text, overlapping ones too, and give the same rows.  Only
a list within its bound is collected or broadcast.  (Left to itself, Spark takes the size of the
unexploded texts for that of their places and may broadcast those.)
"""

from __future__ import annotations

import re
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_chat_default

_ANCHORS = (1, 2, 4)
_PIECE = 32
PATTERN_BYTES = 1 << 20
BROADCAST_BYTES = 8 << 20
TOKEN = r"[\p{L}\p{N}]+"


def _word_table(words: DataFrame, word: str, ignore_case: bool) -> DataFrame:
    w = F.lower(word) if ignore_case else F.col(word)
    return words.select(w.alias("__word")).filter("__word IS NOT NULL AND __word <> ''").distinct()


def longest_word_pattern(words: Iterable[str]) -> str:
    """A pattern whose first group is, at every place, the longest of some words there."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def heads(chars: Iterable[str]) -> str:
        return f"(?=[{''.join(re.escape(ch) for ch in chars)}])"

    def choice(ways: list[tuple[str, str]]) -> str:
        """Alternatives by their first characters, halved so that a place tests few."""
        if len(ways) <= 3:
            return "|".join(way for _, way in ways)
        parts = ways[:len(ways) // 2], ways[len(ways) // 2:]
        return "|".join(f"{heads(ch for ch, _ in part)}(?:{choice(part)})" for part in parts)

    def branch(node: dict) -> str:
        ways = []
        for ch in sorted(c for c in node if c):
            tail, below = re.escape(ch), node[ch]
            while len(below) == 1 and "" not in below:  # a run without branches
                (nxt, below), = below.items()
                tail += re.escape(nxt)
            ways.append((ch, tail + branch(below)))
        if not ways:
            return ""
        return f"(?:{choice(ways)})" + ("?" if "" in node else "")

    return f"{heads(sorted(root))}(?=({branch(root)}))"


def starts_within(words: Sequence[str]) -> list[tuple[str, str]]:
    """(word, listed word that it starts with), itself included."""
    known = set(words)
    return [(w, w[:n]) for w in words for n in range(1, len(w) + 1) if w[:n] in known]


def _anchor_length(n: Column) -> Column:
    return F.when(n >= 4, 4).when(n >= 2, 2).otherwise(1)


def _pieces(text: Column, longest: int) -> Column:
    """Consecutive pieces of a text, each with the start of the next one behind it."""
    step = max(_PIECE, longest)
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % step), F.lit(0))
    after = F.concat(F.slice(cut, 2, F.greatest(F.size(cut), F.lit(1))), F.array(F.lit("")))
    joined = F.zip_with(cut, after, lambda a, b: F.concat(a, F.left(b, F.lit(longest - 1))))
    return F.when(F.size(cut) > 0, joined).otherwise(F.array().cast("array<string>"))


def _grams(piece: Column, k: int) -> Column:
    """Every run of k characters of a piece."""
    last = F.length(piece) - (k - 1)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(piece, i, F.lit(k)))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def _anchors(piece: Column, lengths: Sequence[int]) -> Column:
    return F.array_distinct(F.concat(*[_grams(piece, k) for k in lengths]))


def listed_words(texts: DataFrame, keys: Sequence[str], text: str, words: DataFrame, word: str, *,
                 mode: str = "substring", ignore_case: bool = False) -> DataFrame:
    """(keys, word): every listed word that a text of that key holds, once."""
    ks = list(keys)
    body = null_chat_default(text)
    body = F.lower(body) if ignore_case else body
    src = texts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(ks)], body.alias("__text"))
    key = [F.col(f"__k{i}") for i in range(len(ks))]
    if mode not in ("substring", "word"):
        raise ValueError(f"unknown match mode {mode!r}")
    listed = _word_table(words, word, ignore_case)
    size = F.length("__word")
    shape = listed.agg(F.max(size).alias("longest"), F.collect_set(_anchor_length(size)).alias("anchors"),
                       F.coalesce(F.sum(F.octet_length("__word") + 32), F.lit(0)).alias("bytes"),
                       F.coalesce(F.bool_and(F.regexp_replace("__word", TOKEN, "") == ""), F.lit(False)).alias("runs")).first()

    def beside(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if shape["bytes"] <= BROADCAST_BYTES else table.hint("merge")

    if mode == "word":
        bad = F.raise_error(F.concat(F.lit("not one run of letters and digits: "), F.col("__word")))
        listed = listed.select(F.when(F.regexp_replace("__word", TOKEN, "") == "", F.col("__word")).otherwise(bad).alias("__word"))
        found = src.select(*key, F.explode(F.array_distinct(F.regexp_extract_all("__text", F.lit(TOKEN), F.lit(0)))).alias("__word")) \
            .join(beside(listed), "__word", "left_semi")
    else:
        lengths = [k for k in _ANCHORS if k in set(shape["anchors"])]
        if not lengths:
            found = src.select(*key, F.lit(None).cast("string").alias("__word")).filter(F.lit(False))
        elif shape["bytes"] <= PATTERN_BYTES:
            known = sorted(r[0] for r in listed.collect())
            starts = src.sparkSession.createDataFrame(starts_within(known), "__longest string, __word string")
            if shape["runs"]:
                src = src.withColumn("__text", F.array_join(F.array_distinct(F.regexp_extract_all("__text", F.lit(TOKEN), F.lit(0))), " "))
            src = src.repartition(4 * src.sparkSession.sparkContext.defaultParallelism)
            places = F.regexp_extract_all("__text", F.lit(longest_word_pattern(known)), F.lit(1))
            found = src.select(*key, F.explode(F.array_distinct(places)).alias("__longest")) \
                .join(F.broadcast(starts), "__longest").select(*key, "__word")
        else:
            piece = src.select(*key, F.explode(_pieces(F.col("__text"), shape["longest"])).alias("__piece"))
            places = piece.select(*key, "__piece", F.explode(_anchors(F.col("__piece"), lengths)).alias("__anchor"))
            listed = listed.withColumn("__anchor", F.left(F.col("__word"), _anchor_length(size)))
            found = places.hint("merge").join(listed.hint("merge"), "__anchor").filter(F.contains("__piece", "__word")).select(*key, "__word")
    return found.distinct().select(*[c.alias(k) for c, k in zip(key, ks)], F.col("__word").alias("word"))


def listed_word_hits(texts: DataFrame, keys: Sequence[str], text: str, words: DataFrame, word: str, *,
                     mode: str = "substring", ignore_case: bool = False, name: str = "hits") -> DataFrame:
    """(keys, hits): the number of distinct listed words of every key, 0 where there is
    none; rows that share a key count as one text.  A null text counts as elsewhere
    in the library (a harmless stand-in); null and empty words are not listed."""
    ks = list(keys)
    found = listed_words(texts, ks, text, words, word, mode=mode, ignore_case=ignore_case)
    every = texts.select(*ks, F.lit(None).cast("string").alias("word"))
    return found.unionByName(every).groupBy(*ks).agg(F.count("word").cast("int").alias(name))
