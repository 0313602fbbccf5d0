"""Packing token sequences by minimum bin slack.

Documents are tokenized, closed with an end id and cut into pieces of at most
``capacity`` tokens. What a packing needs to know of the pieces is how many
there are of each length, at most ``capacity`` numbers, whatever the size of the
input. Bin by bin, a bitset dynamic program over the lengths that are left
finds the fullest combination that holds the longest piece left; it is removed
as often as the counts allow. Each combination uses up a length, so there are
at most as many combinations as lengths. Pieces are then numbered within their
length, which tells the bin and the place of each without moving any text.

``sequences`` joins the plan to the tokens where the token ids are wanted.

Defined cases: a NULL or empty text is the end id alone; NULL and repeated ids
are rows of their own (equal rows take their places in any order); a text of any
length is cut into as many pieces as it needs; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import Workspace, numbered

CAPACITY, END_ID = 1024, 2
VOCABULARY = "byte_bpe_50k.json"
#: How the vocabulary's tokenizer splits text before merging; fixed by the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs that are left to the slower library.
RUNS = re.compile(r"\s{2000}|\S{20000}")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _bytes_of(token: str) -> bytes:
    """A token of a byte-level vocabulary as bytes: printable Latin-1 stands for itself, the other bytes for U+0100 onwards."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return bytes(moved.get(c, ord(c)) for c in token)


class Tokens:
    """Token ids of texts by the vocabulary file.

    The merges are run by the faster of two libraries that give equal ids; texts with
    runs that its pattern engine can't take go to the other one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {_bytes_of(t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True

    def ids(self, text: str) -> np.ndarray:
        if RUNS.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece, without texts: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``)."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(vocabulary)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([tokens.ids(text or ""), end])
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (doc_id, k, start, length, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype("int32")) if with_ids else row)
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(tokenize, schema)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths whose sum comes as near to ``room`` as the counts allow; bit ``s`` of a set says that ``s`` can be reached."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        left = min(counts[length], room // length) if length <= room else 0
        lot = 1
        while left > 0:
            lot = min(lot, left)
            steps.append((length, lot, reach))
            reach |= (reach << (length * lot)) & mask
            left -= lot
            lot *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, lot, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * lot
            total -= length * lot
    return out


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths, longest first, and how many bins of each to fill; uses up all counts."""
    counts = {length: n for length, n in counts.items() if n}
    out = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = [longest, *fullest(sorted(counts, reverse=True), counts, capacity - longest)]
        counts[longest] += 1
        need = {length: chosen.count(length) for length in set(chosen)}
        bins = min(counts[length] // n for length, n in need.items())
        for length, n in need.items():
            counts[length] -= n * bins
            if not counts[length]:
                del counts[length]
        out.append((tuple(sorted(chosen, reverse=True)), bins))
    return out


def pattern_table(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, last, sequence_id of the first, offset)``: the pieces ``first`` to ``last`` of a length go to consecutive bins."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, bins in patterns:
        offset = 0
        for length in lengths:
            start = used.get(length, 0)
            rows.append((length, start, start + bins - 1, base, offset))
            used[length] = start + bins
            offset += length
        base += bins
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of every piece. The table joined to the pieces has at most ``capacity ** 2`` short rows."""
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    table = pattern_table(bin_patterns(counts, capacity))
    plan = pieces.sparkSession.createDataFrame(
        [(length, [(a, b, s, o) for n, a, b, s, o in table if n == length]) for length in sorted(counts)] or [(0, [])],
        "_length long, spans array<struct<first:long, last:long, base:long, offset:long>>",
    )
    # The row number is written with the pieces, so equal pieces are spread like others.
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32", "_row"], "_rank")
    span = F.filter("spans", lambda s: (s["first"] <= F.col("_rank")) & (F.col("_rank") <= s["last"]))[0]
    found = ranked.join(F.broadcast(plan), F.col("length") == F.col("_length")).withColumn("_span", span)
    return found.select(
        *(c for c in pieces.columns if c != "_row"), (F.col("_span.base") + F.col("_rank") - F.col("_span.first")).alias("sequence_id"),
        F.col("_span.offset").alias("offset"))


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packing: one row per piece."""
    work = Workspace(docs.sparkSession, "packing")
    pieces = pieces_of(docs, vocabulary or default_vocabulary(), capacity, end_id)
    return place(work.table("pieces", pieces.withColumn("_row", F.monotonically_increasing_id())), capacity)


def sequences(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed token ids: ``sequence_id, ids``. A sequence has at most ``capacity`` ids, so its group is small."""
    work = Workspace(docs.sparkSession, "packing")
    pieces = pieces_of(docs, vocabulary or default_vocabulary(), capacity, end_id, with_ids=True)
    placed = place(work.table("pieces", pieces.withColumn("_row", F.monotonically_increasing_id())), capacity)
    parts: Column = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
