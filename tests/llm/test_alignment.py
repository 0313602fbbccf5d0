"""Token alignment against a byte-by-byte search for common ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from trendlake.llm import alignment
from trendlake.llm.alignment import align, alignment_groups, coalesced, default_pieces, op13_alignment, pair_counts
from trendlake.llm.packing import _bytes_of, default_vocabulary

from .helpers import awkward, documents, words

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A = Tokenizer.from_file(default_vocabulary())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=default_pieces())


def piece_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def groups(text):
    """Groups of ``(a ids, b ids, start, end)`` of a text, from the sets of byte offsets where tokens end."""
    if not text:
        return []
    data = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    parts = [[_bytes_of(A.id_to_token(i)) for i in a], [piece_bytes(i) for i in b]]
    if any(b"".join(p) != data for p in parts):
        return []
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    out, start, done = [], 0, [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        upto = [at.index(cut, n) + 1 for at, n in zip(ends, done)]
        out.append((a[done[0]:upto[0]], b[done[1]:upto[1]], start, cut))
        start, done = cut, upto
    return out


def brute(rows):
    found = [groups(text) for _, text, *_ in rows]
    counts = Counter(p for own in found for p in {(x, y) for a, b, *_ in own for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc_id, *_), own in zip(rows, found):
        links = [(x, y) for a, b, *_ in own for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, *_ in own)
        out.append((doc_id, sum(len(a) for a, *_ in own), sum(len(b) for _, b, *_ in own), len(own), len(links),
                    sum(counts[x] == highest[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if own else ""))
    return sorted(out, key=repr), counts, highest


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def odd_texts():
    rng = random.Random(4)
    texts = ["▁", "a▁b", "<s> </s> <unk> <0x41> <|endoftext|>", " leading", "  two  ", "trailing ", "\n\n\n", "\t", "\x00\x01", "é" * 50, "漢字かな交じり文", "😀👩‍👩‍👧",
             "= " * 30, "=" * 90, "x" * 300, "12345 67.89", "don't we'll", "ﬁ ½ ①", " nbsp　", "a\r\nb", "é combining", "﻿bom", words(rng, 300)]
    return [(i, t, "en", "a") for i, t in enumerate(texts, 500)]


def test_awkward_rows_and_odd_texts(spark):
    rows = [(*r[:1], " ".join(r[1].split()[:600]) if r[1] and len(r[1]) > 50_000 else r[1], *r[2:]) for r in awkward()] + odd_texts()
    expected, counts, highest = brute(rows)
    assert result(align(documents(spark, rows))) == expected
    # Chunks of one document each, and groups by distinct ids: the same.
    assert result(align(documents(spark, rows).repartition(3), chunk_chars=1)) == expected
    pairs = {(r["a_id"], r["b_id"]): (r["documents"], r["best"]) for r in pair_counts(documents(spark, rows)).collect()}
    assert pairs == {p: (n, n == highest[p[0]]) for p, n in counts.items()}


def test_groups_have_their_spans(spark):
    rows = odd_texts() + [(1, None, None, None), (2, "", None, None)]
    found = sorted(map(tuple, alignment_groups(documents(spark, rows), chunk_chars=100).collect()))
    expected = [(doc_id, i, s, e, a, b) for doc_id, text, *_ in rows for i, (a, b, s, e) in enumerate(groups(text))]
    assert found == sorted(expected)


def test_large_groups_go_by_distinct_ids():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    a_group, b_group = np.sort(rng.integers(0, 3, 400)), np.sort(rng.integers(0, 3, 300))
    arguments = (a, b, a_group, b_group, np.bincount(a_group, minlength=3), np.bincount(b_group, minlength=3), np.array([0, 0, 1]), 7, 63)
    expected = Counter(int(np.array([0, 0, 1])[g] * 63 + x * 7 + y) for x, g in zip(a, a_group) for y, h in zip(b, b_group) if g == h)
    for limit in (1 << 16, 0):
        alignment.EXPANDED, keep = limit, alignment.EXPANDED
        codes, times = alignment._links(*arguments)
        alignment.EXPANDED = keep
        assert dict(zip(codes.tolist(), times.tolist())) == expected


def test_groups_break_where_both_end():
    rng = random.Random(7)
    for _ in range(50):
        n = rng.randint(1, 40)
        a, b = ([x - y for x, y in zip(c[1:], c)] for c in (sorted({0, n, *rng.choices(range(n), k=rng.randint(0, n))}) for _ in range(2)))
        a_group, b_group, start, end = coalesced(np.array(a), np.array(b))
        ends = sorted(set(np.cumsum(a).tolist()) & set(np.cumsum(b).tolist()))
        assert end.tolist() == ends and start.tolist() == [0, *ends[:-1]]
        assert a_group.tolist() == np.searchsorted(ends, np.cumsum(a)).tolist() and b_group.tolist() == np.searchsorted(ends, np.cumsum(b)).tolist()


def test_equal_rows_and_empty_table(spark):
    text = "the same text in all of them"
    rows = [(None, text, "en", "a")] * 500 + [(7, "another text", "en", "a")]
    assert result(align(documents(spark, rows))) == brute(rows)[0]
    assert align(documents(spark, [])).count() == 0
    assert result(align(documents(spark, [(1, None, "x", "y")]))) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op13_alignment(spark, folder)) == brute(rows)[0]
