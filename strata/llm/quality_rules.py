"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one integer whose bit ``r`` says that rule ``r`` failed.  A *policy* is a
versioned set of rules, i.e. a mask: applying one, comparing two, or asking
what a rule costs never reads a text again; it is bitwise work on the stored
ledger.  The pipeline's stage keeps its verdicts and needs the ledger only once,
so there it is computed beside the rows and not stored.

Defined results: a null or empty text has no words, all measurements 0, and
fails ``too_few_words``.  Repeated rows give one ledger row each, a null id
stays null, an id that is no whole number raises (it is cast to long).  Other
input columns are ignored unless carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, kept_table, map_chunks, pick

LEDGER = ("doc_id long, n_words long, word_chars long, n_symbols long, n_lines long, "
          "n_dup_lines long, n_repeat_words long, n_plain_words long")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set bytes in each row of the chunk."""
    acc = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=acc[1:])
    return acc[off[1:]] - acc[off[:-1]]


def _salted(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return T.mix(h + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurs at least twice."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _lines(c: T.Chunk) -> T.Words:
    """The \\n-split lines that hold a word, as byte ranges."""
    brk = np.flatnonzero(c.buf == 10)
    start = np.union1d(c.off[:-1], brk + 1)
    start = start[start < len(c.buf)]
    end = np.append(start[1:], len(c.buf))
    newline = np.zeros(len(c.buf) + 1, bool)
    newline[brk + 1] = True
    end = end - newline[end]
    ink = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(~T.SPACE[c.buf], out=ink[1:])
    has = ink[end] > ink[start]
    start, end = start[has], end[has]
    return T.Words(start, end, np.searchsorted(start, c.off))


def _measure(rows: pa.RecordBatch, c: T.Chunk) -> dict:
    w = T.words(c)
    h = T.word_hashes(c, w)
    ink = ~T.SPACE[c.buf]
    symbols = SYMBOLS[c.buf]
    heads = (c.buf & 0xC0) != 0x80

    lines = _lines(c)
    key = _salted(T.word_hashes(c, lines), lines.row)
    _, first = np.unique(key, return_index=True)
    distinct = np.bincount(lines.row[first], minlength=c.rows)

    s = T.window_starts(w, 3)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(s):
        hit = s[repeated(_salted(T.window_hashes(h, 3)[s], w.row[s]))]
        mark = np.zeros(len(h), bool)
        for k in range(3):
            mark[hit + k] = True
        np.cumsum(mark, out=covered[1:])

    bad = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(symbols, out=bad[1:])
    plain = np.zeros(len(h) + 1, np.int64)
    np.cumsum(bad[w.end] == bad[w.start], out=plain[1:])
    return {"doc_id": column(rows, "doc_id"), "n_words": w.counts,
            "word_chars": _per_row(ink & heads, c.off), "n_symbols": _per_row(symbols, c.off),
            "n_lines": lines.counts, "n_dup_lines": lines.counts - distinct,
            "n_repeat_words": covered[w.first[1:]] - covered[w.first[:-1]],
            "n_plain_words": plain[w.first[1:]] - plain[w.first[:-1]]}


def _rules() -> list[tuple[str, Column]]:
    """(name, failed) in bit order; integer arithmetic, so every engine agrees."""
    c = F.col
    return [
        ("too_few_words", c("n_words") < 50),
        ("repeated_words", 100 * c("n_repeat_words") > 50 * c("n_words")),
        ("many_symbols", 100 * c("n_symbols") > 25 * c("n_words")),
        ("duplicate_lines", 100 * c("n_dup_lines") > 50 * c("n_lines")),
        ("short_words", c("word_chars") < 2 * c("n_words")),
        ("long_words", c("word_chars") > 20 * c("n_words")),
        ("few_plain_words", 100 * c("n_plain_words") < 70 * c("n_words")),
    ]


RULES = ["too_few_words", "repeated_words", "many_symbols", "duplicate_lines", "short_words",
         "long_words", "few_plain_words"]
POLICIES = {
    "base": ["too_few_words", "repeated_words"],
    "v1": ["too_few_words", "repeated_words", "many_symbols", "duplicate_lines"],
    "v2": RULES,
}
CURRENT = "v2"


def mask_of(names: list[str]) -> int:
    return sum(1 << RULES.index(n) for n in names)


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: measurements and ``failed_bits``.

    ``carry``: columns kept beside the ledger, as the struct ``row``.  They
    travel with the text (no shuffle), so rows of one id need no join by it.
    """
    cols, schema = {"doc_id": docs[doc_id].cast("long"), "text": docs[text]}, LEDGER
    if carry is not None:
        cols["row"] = F.struct(*[docs[c] for c in carry])
    rows = pick(docs, **cols)
    if carry is not None:
        schema += f", row {rows.schema['row'].dataType.simpleString()}"

    def measure(b: pa.RecordBatch, c: T.Chunk) -> dict:
        out = _measure(b, c)
        return out if carry is None else out | {"row": column(b, "row")}

    bits = F.lit(0).cast("long")
    for i, (_, failed) in enumerate(_rules()):
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return map_chunks(rows, measure, schema).withColumn("failed_bits", bits)


def stored_ledger(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """The ledger, written once (to ``path``, else a table in the shared folder)
    and read back: every rule is evaluated in this one pass over the texts, and
    policies and ablations read the table."""
    led = ledger(docs, **options)
    if path is None:
        return kept_table(led, "quality-ledger")
    led.write.mode("error").parquet(path)
    return docs.sparkSession.read.schema(led.schema).parquet(path)


def failed_any(policy: str, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) != 0


def apply_policy(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    return led.withColumn("kept", ~failed_any(policy))


def ablation(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: failures, failures by this rule alone, and documents
    kept with and without it.

    The ledger is first reduced to one row per distinct bit pattern (at most
    2 ** rules), map-side; the rules then meet these few rows.
    """
    mask = mask_of(POLICIES[policy])
    counts = led.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    masked = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))
    aggs = []
    for r in POLICIES[policy]:
        bit = 1 << RULES.index(r)
        aggs.append(F.struct(
            F.lit(r).alias("rule"),
            F.coalesce(F.sum(F.when(masked.bitwiseAND(F.lit(bit).cast("long")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(masked == bit, F.col("n"))), F.lit(0)).alias("n_failed_alone"),
            F.coalesce(F.sum(F.when(masked == 0, F.col("n"))), F.lit(0)).alias("n_kept"),
            F.coalesce(F.sum(F.when(masked.bitwiseAND(F.lit(mask & ~bit).cast("long")) == 0, F.col("n"))),
                       F.lit(0)).alias("n_kept_without")))
    return counts.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def verdicts(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    """A ledger under a policy, with the base verdict beside it."""
    led = apply_policy(led, policy).withColumn("base_failed", failed_any("base"))
    return led.withColumn("kept", F.col("kept") & ~F.col("base_failed"))


def ablations(led: DataFrame) -> DataFrame:
    """The ablation of every policy, one row per policy and rule."""
    out = None
    for p in POLICIES:
        one = ablation(led, p).select(F.lit(p).alias("policy"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def keep_clean(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents a policy keeps, with all their columns, in one pass: the
    ledger is computed beside the row."""
    return verdicts(ledger(docs, carry=docs.columns), policy).filter("kept").select("row.*")
