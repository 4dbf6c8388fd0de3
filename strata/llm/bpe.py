"""BPE encoding and decoding of whole texts, with tree concatenation.

Texts up to ``split_chars`` are encoded where they lie.  A longer one is cut
into pieces that other tasks encode, in two steps:

* at places where the tokenizer always splits (before a single space inside
  other text) the pieces are independent and their ids are simply concatenated;
* a single pre-token longer than the bound (an unsplit run: no place to cut) is
  halved by bytes until the halves fit.  Neighbouring halves are then joined
  level by level: the tokens around the join are re-encoded in a window that
  grows until its first token agrees with the left half and its last with the
  right half.  Two adjacent tokens that survive re-encoding in a common window
  are a valid pair, and a token sequence whose adjacent pairs are all valid is
  the BPE encoding, so the joined ids are exact.

The vocabulary is read from the given ``tokenizer.json`` (byte-level BPE whose
ids follow the merge order; anything else raises).  Its path is a parameter and
must exist on every worker.

Defined results: null encodes as the empty text (no ids, decoded ``''``); rows
with repeated or null ids are handled row by row; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import column, map_chunks, pick, python_ready

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT_CHARS = 1 << 16
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_CODECS: dict[str, "Codec"] = {}


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes: visible
    Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for i, b in enumerate(x for x in range(256) if x not in set(shown)):
        out[chr(0x100 + i)] = b
    return out


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        plain = {t: i for t, i in vocab.items() if t not in special}
        if spec["model"]["type"] != "BPE" or any(plain[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
            raise ValueError(f"{path}: not a byte-level BPE whose ids follow the merge order")
        ranks = {bytes(letters[c] for c in t): i for t, i in plain.items()}
        self.special = sorted(special, key=len, reverse=True)
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if special else None
        self.special_ids = special
        self.enc = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)

    def encode(self, text: str) -> list[int]:
        return self.enc.encode(text, allowed_special="all")

    def decode(self, ids) -> str:
        return self.enc.decode_bytes(ids).decode("utf-8", "replace")

    def run(self, piece: bytes) -> list[int]:
        """BPE of one unsplit run of bytes."""
        return self.enc._encode_single_piece(piece)

    def pretokens(self, text: str) -> Iterator[str]:
        """The pieces in which the tokenizer splits a text before merging."""
        for _, (lo, hi) in self._splitter.pre_tokenize_str(text):
            yield text[lo:hi]

    def token(self, i: int) -> bytes:
        return self.enc.decode_single_token_bytes(int(i))


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def join_runs(c: Codec, left: list[int], right: list[int], window: int = 4) -> list[int]:
    """Ids of the concatenation of two encoded halves of one unsplit run.

    ``window`` tokens on each side are re-encoded; it doubles until the result
    begins and ends with the tokens that are there, or a whole side is inside.
    """
    if not left or not right:
        return left + right
    while True:
        a, b = min(window, len(left)), min(window, len(right))
        body = b"".join(c.token(i) for i in left[-a:]) + b"".join(c.token(i) for i in right[:b])
        mid = c.run(body)
        left_ok = a == len(left) or mid[0] == left[-a]
        right_ok = b == len(right) or mid[-1] == right[b - 1]
        if left_ok and right_ok:
            return left[:-a] + mid + right[b:]
        window *= 2


def join_tree(c: Codec, parts: list[list[int]]) -> list[int]:
    """Pairwise joins of neighbouring halves, level by level."""
    while len(parts) > 1:
        parts = [join_runs(c, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _halves(run: bytes, limit: int) -> list[bytes]:
    """A run cut in the middle until every part fits, in order."""
    if len(run) <= limit:
        return [run]
    mid = len(run) // 2
    return _halves(run[:mid], limit) + _halves(run[mid:], limit)


def pieces(c: Codec, text: str, limit: int) -> Iterator[tuple[int, bytes]]:
    """(kind, bytes) in order.  Kind 0: an independent piece of text.  Kind n > 0:
    a part of the n-th unsplit run, to be joined with the run's other parts."""
    runs, at = 0, 0
    marks = [m.span() for m in c.special_re.finditer(text)] if c.special_re else []
    for lo, hi in [*marks, (len(text), len(text))]:
        while at < lo:
            end = lo
            if lo - at > limit:
                cut = _CUT.search(text, at + limit // 2, min(lo, at + limit))
                end = cut.start() if cut else 0
            if end:
                yield 0, text[at:end].encode()
                at = end
                continue
            # no sure cut within the bound: split as the tokenizer does, up to the next sure cut
            cut = _CUT.search(text, at + limit // 2, lo)
            end = cut.start() if cut else lo
            batch: list[str] = []
            size = 0
            for tok in c.pretokens(text[at:end]):
                if len(tok) > limit // 2:
                    if batch:
                        yield -1, json.dumps(batch).encode()
                        batch, size = [], 0
                    runs += 1
                    for part in _halves(tok.encode(), limit // 2):
                        yield runs, part
                    continue
                batch.append(tok)
                size += len(tok)
                if size > limit // 2:
                    yield -1, json.dumps(batch).encode()
                    batch, size = [], 0
            if batch:
                yield -1, json.dumps(batch).encode()
            at = end
        if hi > lo:
            yield 0, text[lo:hi].encode()
            at = hi


def encode_piece(c: Codec, kind: int, body: bytes) -> list[int]:
    if kind > 0:
        return c.run(body)
    if kind == 0:
        return c.encode(body.decode())
    return [i for t in json.loads(body) for i in c.run(t.encode())]


def assemble(c: Codec, parts: list[tuple[int, list[int]]]) -> list[int]:
    """Ids of the whole text from its encoded pieces, in order."""
    out: list[int] = []
    group: list[list[int]] = []
    for i, (kind, ids) in enumerate(parts):
        if kind > 0:
            group.append(ids)
            if i + 1 == len(parts) or parts[i + 1][0] != kind:
                out += join_tree(c, group)
                group = []
        else:
            out += ids
    return out


def encode_text(c: Codec, text: str, limit: int = SPLIT_CHARS) -> list[int]:
    """One text, in this process (what the distributed form computes)."""
    if len(text) <= limit:
        return c.encode(text)
    return assemble(c, [(k, encode_piece(c, k, b)) for k, b in pieces(c, text, limit)])


def _lists(ids: list) -> pa.Array:
    off = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=off[1:])
    flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str, carry: list[str] | None = None, text: str = "text",
           split_chars: int = SPLIT_CHARS, decoded: bool = False) -> DataFrame:
    """The carried columns (doc_id), ids array<int>[, decoded string] of every
    whole text."""
    src = pick(docs, row=F.struct(*[docs[c] for c in carry or ["doc_id"]]), text=F.coalesce(docs[text], F.lit("")))
    row_type = src.schema["row"].dataType.simpleString()
    out = f"row {row_type}, ids array<int>" + (", decoded string" if decoded else "")

    def short(rows: pa.RecordBatch, _) -> dict:
        c = codec(path)
        ids = [c.encode(t) for t in column(rows, "text").to_pylist()]
        res = {"row": column(rows, "row"), "ids": _lists(ids)}
        if decoded:
            res["decoded"] = [c.decode(x) for x in ids]
        return res

    def cut(rows: pa.RecordBatch, _) -> dict:
        c = codec(path)
        got = [(r, seq, k, b) for r, t in enumerate(column(rows, "text").to_pylist())
               for seq, (k, b) in enumerate(pieces(c, t, split_chars))]
        at = pa.array([g[0] for g in got], pa.int32())
        return {"row": column(rows, "row").take(at), "at": column(rows, "at").take(at), "seq": [g[1] for g in got],
                "kind": [g[2] for g in got], "text": pa.array([g[3] for g in got], pa.binary())}

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = [encode_piece(c, k, x) for k, x in zip(column(b, "kind").to_pylist(), column(b, "text").to_pylist())]
            yield pa.RecordBatch.from_arrays([column(b, n) for n in ("row", "at", "seq", "kind")] + [_lists(ids)],
                                             names=["row", "at", "seq", "kind", "ids"])

    def whole(table: pa.Table) -> pa.Table:
        c = codec(path)
        table = table.combine_chunks()
        order = pa.compute.sort_indices(table["seq"])
        ids = assemble(c, list(zip(table["kind"].take(order).to_pylist(), table["ids"].take(order).to_pylist())))
        cols, names = [table["row"].chunk(0).slice(0, 1), _lists([ids])], ["row", "ids"]
        if decoded:
            cols, names = [*cols, pa.array([c.decode(ids)], pa.string())], [*names, "decoded"]
        return pa.Table.from_arrays(cols, names=names)

    long_text = F.length("text") > split_chars
    near = map_chunks(src.filter(~long_text), short, out)
    key = f"row {row_type}, at long, seq int, kind int"
    cuts = map_chunks(src.filter(long_text).withColumn("at", F.monotonically_increasing_id()), cut, f"{key}, text binary")
    far = cuts.repartition("at", "seq").mapInArrow(encode_pieces, f"{key}, ids array<int>") \
        .groupBy("at").applyInArrow(whole, out)
    return near.unionByName(far).select("row.*", "ids", *(["decoded"] if decoded else []))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The frame with a column ``decoded``: the text of each list of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            text = [c.decode(x or []) for x in column(b, ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], names=[*b.schema.names, "decoded"])

    python_ready(encoded.sparkSession)
    base = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, f"{schema}, decoded string")
