"""Hand-made tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string, _key string, score double"


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents(spark, rows):
    """Rows ``(doc_id, text, lang, source)`` as documents with columns that clash with names the operators may use."""
    return spark.createDataFrame([(i, t, lang, s, len(t) if t else None, "x", "k", 0.5) for i, t, lang, s in rows], DOCS)


def awkward(seed: int = 3):
    """NULLs, empty and blank texts, one-word texts, repeated rows and ids, copies, near copies, one long text."""
    rng = random.Random(seed)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", None), (4, None, "en", "a"), (5, "", "de", "b"),
        (6, " \t\n ", None, "b"), (7, "one", "de", "b"), (8, "ONE", "de", None), (9, "two words", "de", "c"), (9, "two words", "de", "c"),
        (10, "two  words", "fr", "c"), (11, "12 34 !!", "fr", "c"), (None, base, "en", "a"), (None, None, None, None),
        (12, words(rng, 30_000), "en", "a"), (13, "É ß 漢字 😀 " * 3, "fr", "b"), (13, words(rng, 40), "fr", "b"),
        (-5, base.upper(), "en", "c"),
    ]
    return rows + [(100 + i, words(rng, rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice("abc")) for i in range(40)]


def components(nodes, links):
    """Smallest node reachable from each node, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    least = {}
    for n in sorted(near):
        if n not in least:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in least:
                    least[x] = n
                    todo += near[x]
    return least
