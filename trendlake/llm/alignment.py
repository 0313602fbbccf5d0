"""Aligning the tokens of two tokenizers by interval coalescing.

Tokenizer A is a byte-level vocabulary, B a piece model with byte fallback. Both
cut the same bytes, a space and the text, into tokens. All tokens of both are
sorted by start (``lexsort``); over their ends runs a maximum
(``maximum.accumulate``), and a group breaks where a start reaches it. So a group
ends exactly where a token of A and one of B end together. Every A token is
linked with every B token of its group.

A pair of ids counts the documents that hold it linked. Documents are aligned in
chunks of about ``chunk_chars`` characters; a chunk keeps its distinct pairs once
and its documents as places in that list, so what is shuffled for the counts
grows with the chunks' distinct pairs, not with the links. Pairs are summed over
the corpus, the best count of each A id (at most as many rows as A has ids) is
joined to them, and the counts go back to the chunk they came from.

``alignment_groups`` gives the groups themselves, ``pair_counts`` the corpus-wide
table of pairs, ``align`` one row per document.

Defined cases: a NULL or empty text, and a text whose tokens don't give back its
bytes, has no tokens: all its numbers are 0 and its ``groups`` are empty; NULL
and repeated ids are rows like others, and rows with equal text count one by
one; a very long text is a chunk of its own, and a group too large to expand is
linked by its distinct ids; pairs of an A id with equal counts are all best; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packing import Tokens, default_vocabulary
from .shared import Workspace
from .textscan import by_bytes

PIECES = "piece_bpe_32k.model"
#: Links of one group that are expanded token by token; larger groups go by their distinct ids.
EXPANDED = 1 << 16
SPACE = "▁"

#: Rows of documents, and rows of a chunk's distinct pairs with ``place`` and ``docs``.
ALIGNED = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "places binary, times binary, place int, pair long, docs long")
GROUPS = "doc_id long, group_no int, start long, end long, a_ids array<int>, b_ids array<int>"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


class TwoTokenizers:
    """Ids of both tokenizers, and the bytes that each id stands for."""

    def __init__(self, vocabulary: str, pieces: str):
        self.first = Tokens(vocabulary)
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        ranks = self.first.fast
        self.a_bytes = [ranks.decode_single_token_bytes(i) for i in range(ranks.n_vocab)]
        self.b_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.a_lengths, self.b_lengths = (np.array([len(b) for b in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i) else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B for each text; both empty where their bytes are not a space and the text."""
        out = []
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            whole = " " + text
            a, data = self.first.ids(whole), whole.encode("utf-8", "surrogatepass")
            same = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == data and b"".join(map(self.b_bytes.__getitem__, b)) == data
            out.append((a.astype(np.int64), np.array(b, dtype=np.int64)) if same else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        return out


def coalesced(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The group of every A and of every B token, and the groups' starts and ends, of tokens that cut the same bytes."""
    if not len(a_lengths):
        return (np.zeros(0, dtype=np.int64),) * 4
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    ends = np.concatenate((a_ends, b_ends))
    starts = np.concatenate((a_ends - a_lengths, b_ends - b_lengths))
    of_b = np.zeros(len(ends), dtype=np.int8)
    of_b[len(a_ends):] = 1
    order = np.lexsort((of_b, starts))
    sorted_starts, reached = starts[order], np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), dtype=bool)
    breaks[1:] = sorted_starts[1:] >= reached[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks) - 1
    first = np.flatnonzero(breaks)
    last = np.append(first[1:], len(order)) - 1
    return group[:len(a_ends)], group[len(a_ends):], sorted_starts[first], reached[last]


def _links(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_count: np.ndarray, b_count: np.ndarray,
           doc_of: np.ndarray, b_ids: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``document * span + pair`` codes of all links, sorted, and how often each is linked."""
    b_first = np.cumsum(b_count) - b_count
    small = a_count * b_count <= EXPANDED
    partners = np.where(small, b_count, 0)[a_group]
    of_a = np.repeat(np.arange(len(a)), partners)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(partners) - partners, partners) + b_first[a_group[of_a]]
    codes, times = np.unique(doc_of[a_group[of_a]] * span + a[of_a] * b_ids + b[of_b], return_counts=True)
    if small.all():
        return codes, times
    a_first = np.cumsum(a_count) - a_count
    parts = [(codes, times)]
    for g in np.flatnonzero(~small):
        own_a, n_a = np.unique(a[a_first[g]:a_first[g] + a_count[g]], return_counts=True)
        own_b, n_b = np.unique(b[b_first[g]:b_first[g] + b_count[g]], return_counts=True)
        parts.append(((doc_of[g] * span + own_a[:, None] * b_ids + own_b).ravel(), (n_a[:, None] * n_b).ravel()))
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.zeros(len(codes), dtype=np.int64)
    np.add.at(times, back, np.concatenate([p[1] for p in parts]))
    return codes, times


class _Digits:
    """Ids as decimal digits, many at once."""

    def __init__(self, ids: int):
        self.width = len(str(max(ids - 1, 1)))
        names = np.arange(ids)
        self.sizes = np.array([len(str(i)) for i in range(ids)], dtype=np.int64)
        powers = 10 ** np.arange(self.width - 1, -1, -1)
        self.digits = (names[:, None] // powers % 10 + ord("0")).astype(np.uint8)
        self.shown = np.arange(self.width) >= self.width - self.sizes[:, None]

    def joined(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in decimal, each with the byte that stands after it, and the length of each with that byte."""
        text = np.empty((len(ids), self.width + 1), dtype=np.uint8)
        text[:, :-1], text[:, -1] = self.digits[ids], after
        shown = np.ones(text.shape, dtype=bool)
        shown[:, :-1] = self.shown[ids]
        return text[shown], self.sizes[ids] + 1


def _written(a, b, a_group, b_group, a_count, b_count, groups_of: np.ndarray, digits: _Digits) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document, whose groups number ``groups_of``."""
    width = a_count + b_count
    before = np.cumsum(width) - width
    ids = np.empty(len(a) + len(b), dtype=np.int64)
    after = np.full(len(ids), ord(","), dtype=np.uint8)
    ids[before[a_group] + np.arange(len(a)) - (np.cumsum(a_count) - a_count)[a_group]] = a
    ids[(before + a_count)[b_group] + np.arange(len(b)) - (np.cumsum(b_count) - b_count)[b_group]] = b
    after[before + a_count - 1] = ord("|")
    after[before + width - 1] = ord(";")
    text, sizes = digits.joined(ids, after)
    data, upto = text.tobytes(), np.concatenate(([0], np.cumsum(sizes)))
    tokens = np.concatenate(([0], np.cumsum(width)))
    bounds = upto[tokens[np.concatenate(([0], np.cumsum(groups_of)))]]
    return [data[s:max(s, e - 1)].decode() for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as they need."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max))


def _cut(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    data, width = values.tobytes(), values.itemsize
    ends = (np.cumsum(sizes) * width).tolist()
    return [data[s:e] for s, e in zip([0, *ends], ends)]


def _grouped(tokens: TwoTokenizers, encoded: list[tuple[np.ndarray, np.ndarray]]):
    """Tokens of a chunk's documents end to end: ids, groups, tokens by group, document of each group, starts and ends."""
    a, b = (np.concatenate([e[i] for e in encoded]) if encoded else np.zeros(0, np.int64) for i in (0, 1))
    a_group, b_group, start, end = coalesced(tokens.a_lengths[a], tokens.b_lengths[b])
    a_count, b_count = (np.bincount(g, minlength=len(start)) for g in (a_group, b_group))
    sizes = np.array([int(tokens.a_lengths[e[0]].sum()) for e in encoded], dtype=np.int64)
    # Documents without tokens take no bytes, so a group belongs to the first document that ends after its start.
    doc_of = np.searchsorted(np.cumsum(sizes), start, side="right")
    return a, b, a_group, b_group, a_count, b_count, doc_of, start, end, sizes


def _align_chunk(tokens: TwoTokenizers, digits: _Digits, chunk: int, doc_ids: pa.Array, texts: list) -> Iterator[pa.RecordBatch]:
    encoded = tokens.encode([t or "" for t in texts])
    encoded = [e if t else (e[0][:0], e[1][:0]) for e, t in zip(encoded, texts)]
    n, b_ids = len(texts), len(tokens.b_lengths)
    span = len(tokens.a_lengths) * b_ids
    a, b, a_group, b_group, a_count, b_count, doc_of, *_ = _grouped(tokens, encoded)
    groups_of = np.bincount(doc_of, minlength=n)
    linked = np.concatenate(([0], np.cumsum(a_count * b_count)))
    group_ends = np.cumsum(groups_of)
    codes, times = _links(a, b, a_group, b_group, a_count, b_count, doc_of, b_ids, span)
    pairs, place = np.unique(codes % span, return_inverse=True)
    pairs_of = np.bincount(codes // span, minlength=n)
    count = lambda values: pa.array(values, pa.int64())
    yield _rows(
        n, chunk=count(np.full(n, chunk)), doc_id=doc_ids, n_a=count([len(e[0]) for e in encoded]), n_b=count([len(e[1]) for e in encoded]),
        n_groups=count(groups_of), n_links=count(linked[group_ends] - linked[group_ends - groups_of]),
        groups=pa.array(_written(a, b, a_group, b_group, a_count, b_count, groups_of, digits), pa.string()),
        places=pa.array(_cut(_narrow(place), pairs_of), pa.binary()), times=pa.array(_cut(_narrow(times), pairs_of), pa.binary()))
    if len(pairs):
        yield _rows(len(pairs), chunk=count(np.full(len(pairs), chunk)), place=pa.array(np.arange(len(pairs)), pa.int32()),
                    pair=count(pairs), docs=count(np.bincount(place)))


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch with the columns of ``ALIGNED``; those that are not given are NULL."""
    fields = [x.split() for x in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, _TYPES[t])) for c, t in fields], [c for c, _ in fields])


def _chunks(batches: Iterator[pa.RecordBatch], chunk_chars: int) -> Iterator[tuple[int, pa.Array, list]]:
    """Ids and texts of about ``chunk_chars`` characters, with a number that no other task gives."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in by_bytes(texts, chunk_chars):
            yield number, batch.column("doc_id").slice(part.start, part.stop - part.start), texts[part]
            number += 1


def _aligned(docs: DataFrame, vocabulary: str, pieces: str, chunk_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TwoTokenizers(vocabulary, pieces)
        digits = _Digits(max(len(tokens.a_lengths), len(tokens.b_lengths)))
        for chunk, doc_ids, texts in _chunks(batches, chunk_chars):
            yield from _align_chunk(tokens, digits, chunk, doc_ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def alignment_groups(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None, chunk_chars: int = 1 << 20) -> DataFrame:
    """One row per group: its bytes in a space and the text, from ``start`` to ``end``, and the ids of both tokenizers."""
    vocabulary, pieces = vocabulary or default_vocabulary(), pieces or default_pieces()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TwoTokenizers(vocabulary, pieces)
        for _, doc_ids, texts in _chunks(batches, chunk_chars):
            encoded = [tokens.encode([t])[0] if t else (np.zeros(0, np.int64),) * 2 for t in texts]
            a, b, _, _, a_count, b_count, doc_of, start, end, sizes = _grouped(tokens, encoded)
            base = (np.cumsum(sizes) - sizes)[doc_of]
            groups_of = np.bincount(doc_of, minlength=len(texts))
            number = np.arange(len(doc_of)) - (np.cumsum(groups_of) - groups_of)[doc_of]
            ids = [pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(c))).astype(np.int32), pa.array(x, pa.int32()))
                   for x, c in ((a, a_count), (b, b_count))]
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(doc_of)), pa.array(number, pa.int32()), pa.array(start - base), pa.array(end - base), *ids],
                [x.split()[0] for x in GROUPS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, GROUPS)


def _judged(pairs: DataFrame, b_ids: int) -> DataFrame:
    """``pair, documents, best``: one row per pair of ids. The best counts joined to them have one row per A id."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("documents")).withColumn("_a", F.expr(f"pair div {b_ids}"))
    highest = counts.groupBy(F.col("_a").alias("_id")).agg(F.max("documents").alias("_most"))
    return counts.join(highest, F.col("_a") == F.col("_id")).select("pair", "documents", (F.col("documents") == F.col("_most")).alias("best"))


def _b_ids(pieces: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()


def pair_counts(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None, chunk_chars: int = 2 << 20) -> DataFrame:
    """``a_id, b_id, documents, best``: in how many documents a pair is linked, and whether no pair of its A id is in more."""
    pieces = pieces or default_pieces()
    rows = _aligned(docs, vocabulary or default_vocabulary(), pieces, chunk_chars).where("pair is not null").select("pair", "docs")
    stored = Workspace(docs.sparkSession, "alignment").table("pairs", rows)
    b_ids = _b_ids(pieces)
    return _judged(stored, b_ids).select(
        F.expr(f"cast(pair div {b_ids} as int)").alias("a_id"), F.expr(f"cast(pair % {b_ids} as int)").alias("b_id"), "documents", "best")


def align(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None, chunk_chars: int = 2 << 20) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: one row per document."""
    pieces = pieces or default_pieces()
    work = Workspace(docs.sparkSession, "alignment")
    aligned = _aligned(docs, vocabulary or default_vocabulary(), pieces, chunk_chars)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).when(F.col("n_a") == 0, "")
    slim = aligned.withColumn("groups_sha256", digest).drop("groups").withColumn("of_pair", F.col("pair").isNotNull())
    slim.write.partitionBy("of_pair").option("compression", "zstd").parquet(work.folder("chunks"))
    # Two reads: documents and pairs are put side by side below, so their columns must be told apart.
    stored, pairs = (docs.sparkSession.read.schema(slim.schema).parquet(work.folder("chunks")) for _ in range(2))
    pairs = pairs.where("of_pair").select("chunk", "place", "pair", "docs")
    judged = _judged(pairs, _b_ids(pieces)).withColumnRenamed("pair", "_pair")
    back = pairs.join(judged, F.col("pair") == F.col("_pair")).select("chunk", "place", "documents", "best")
    rows = stored.where("not of_pair").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times")
    return rows.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _summed(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one chunk with the counts of their links."""
    place = pairs.column("place").to_numpy()
    documents, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    documents[place], best[place] = pairs.column("documents").to_numpy(), pairs.column("best").to_numpy()
    sums = []
    for places, times, links in zip(rows.column("places").to_pylist(), rows.column("times").to_pylist(), rows.column("n_links").to_pylist()):
        # Both lists have one length; the widths of their numbers follow from the chunk.
        at = np.frombuffer(places, dtype=_unsigned(len(place) - 1)).astype(np.int64)
        n = np.frombuffer(times, dtype=f"<u{len(times) // len(at)}").astype(np.int64) if len(at) else at
        sums.append((int((best[at] * n).sum()), int((documents[at] * n).sum())))
    out = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for i, name in enumerate(("n_best", "count_sum")):
        out = out.append_column(name, pa.array([s[i] for s in sums], pa.int64()))
    return out.append_column("groups_sha256", rows.column("groups_sha256"))


def _unsigned(most: int) -> str:
    return next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
