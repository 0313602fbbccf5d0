"""Near-duplicate documents by SuperMinHash signatures.

Every shingle hands its ranks to the slots of the signature along a random
permutation of its own: at level ``j`` it offers ``j`` plus a random fraction to
one slot it has not visited yet. A slot keeps the least offer. Levels end as
soon as every slot has an offer, since later ones are larger. Bands of the
signature are the buckets; candidates are verified on the full shingle sets;
components of the verified links are the groups.

Texts with equal shingle sets are one class from the start, so copies are never
compared. A bucket hands its members to one leader first; members that are then
in one component need no comparison with each other. What is left in a bucket,
pairs of members of different components, is compared in full: no bucket is
capped. Small buckets hand out their pairs; larger ones are compared block by
block in tasks that return trees of links, so pairs of a crowd are never rows.
With 32 bands of 5 rows a link at the threshold 0.85 shares no bucket
with a probability of 7e-9.

Defined cases: NULL, empty and blank texts have no shingles and link with
nothing; rows without id link with nothing, have no component and are kept;
rows that repeat an id link by their texts only; an empty table gives no rows;
very long texts are scanned in parts; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, components, free_names
from .textscan import lots, mix64, shingle_sets
from .vectors import spanning

BANDS, ROWS = 32, 5
#: Rows with whole texts that a task hands to Python at once; both sides hold them.
TEXT_ROWS = 1_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _draw(elements: np.ndarray, level: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Fraction and place of each element's offer at a level; the place is one of ``level`` to ``slots - 1``."""
    bits = mix64(elements + np.uint64(int(_STEP) * (level + 1) & (1 << 64) - 1))
    pick = ((mix64(bits + _STEP) >> np.uint64(32)) * np.uint64(slots - level)) >> np.uint64(32)
    return (bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53, pick.astype(np.int64) + level


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures of sets of 64-bit elements, one row per set; an empty set's row is infinite."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full((len(sets), slots), np.inf)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = out.reshape(-1)
    fraction, place = _draw(elements, 0, slots)
    np.minimum.at(flat, owner * slots + place, fraction)
    open_ = np.isinf(out).any(axis=1) & (sizes > 0)
    held = np.flatnonzero(open_[owner])
    for at in range(0, len(held), 50_000):
        _finish(out, flat, elements[held[at:at + 50_000]], owner[held[at:at + 50_000]], place[held[at:at + 50_000]], slots)
    return out


def _finish(out, flat, elements, owner, first, slots: int) -> None:
    """The levels after the first, for some of the elements; offers of other elements may be there already."""
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(elements), 1))
    row = np.arange(len(elements))
    order[row, 0], order[row, first] = first, 0
    for level in range(1, slots):
        # An offer of this level can only matter where the present value is larger.
        useful = (out[np.unique(owner)] > level).any(axis=1)
        if not useful.any():
            return
        if useful.mean() < 0.7:
            going = np.zeros(len(out), dtype=bool)
            going[np.unique(owner)[useful]] = True
            keep = going[owner]
            elements, owner, order = elements[keep], owner[keep], order[keep]
            row = np.arange(len(elements))
        fraction, place = _draw(elements, level, slots)
        slot = order[row, place].astype(np.int64)
        order[row, place] = order[row, level]
        order[row, level] = slot
        np.minimum.at(flat, owner * slots + slot, fraction + level)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, bits.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + bits[:, :, r])
    return key.view(np.int64)


def _class_key(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, bands``: the class names the shingle set, NULL for an empty one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in lots(batch.column("text")):
                sets = list(shingle_sets(texts, words))
                keys = band_keys(super_minhash(sets, bands * rows), bands, rows)
                filled = np.array([len(s) > 0 for s in sets])
                offsets = np.concatenate(([0], np.cumsum(filled * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c)[part.start:part.stop] for c in ("doc_id", "text_hash")], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class_key(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[filled].reshape(-1))),
                ], names=["doc_id", "text_hash", "n_shingles", "class", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        scan, "doc_id long, text_hash long, n_shingles long, class binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Full shingle sets of the wanted classes, found by the id that stands for each: ``class, elements``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in lots(batch.column("text")):
                sets = list(shingle_sets(texts, words))
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_class_key(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64))),
                ], names=["class", "elements"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted.select(F.col("doc_id")).distinct(), "doc_id", "left_semi")
    found = texts.mapInArrow(scan, "class binary, elements array<long>")
    return found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def _alike(a: str, b: str, percent: int):
    """Sizes that the threshold allows at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, percent: int, work: Workspace, name: str) -> DataFrame:
    """The pairs of classes that reach the threshold on their full sets."""
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = work.table(f"{name}-wanted", classes.select("class", "doc_id").join(ends, "class"))
    sets = work.table(f"{name}-sets", _sets(docs, wanted, words), TEXT_ROWS)
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("eb"))
    shared = F.size(F.array_intersect("ea", "eb"))
    sized = pairs.join(left, "a").join(right, "b").select(
        "a", "b", shared.alias("shared"), (F.size("ea") + F.size("eb") - shared).alias("joint"))
    links = work.table(f"{name}-links", sized.where(F.col("shared") * 100 >= F.col("joint") * percent).select("a", "b"))
    work.drop(f"{name}-sets", f"{name}-wanted")
    return links


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, bands: int = BANDS, rows: int = ROWS, rounds: int = 1,
                    crowd: int = 48) -> DataFrame:
    """``doc_id, text_hash, group, n_shingles, component_id, kept`` for every row of ``docs``; ``group`` is NULL without shingles."""
    work = Workspace(docs.sparkSession, "minhash")
    signed = work.table("signed", signatures(docs, words, bands, rows), TEXT_ROWS)
    classes = signed.where("class is not null and doc_id is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
    classes = work.table("classes", classes)
    exploded = classes.select(F.explode("bands").alias("key"), "class", "n")
    crowded = exploded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    buckets = work.table("buckets", exploded.join(crowded, "key"))
    names = classes.select("class", "doc_id")

    links, labels, kept = None, None, []
    for turn in range(rounds + 1):
        labelled = work.table(f"open-{turn}", _labelled(buckets, labels))
        if labelled.isEmpty():
            break
        if turn < rounds:
            pairs = work.table(f"pairs-{turn}", _to_leaders(labelled, turn, percent))
            found = _verified(docs, pairs, names, words, percent, work, f"verify-{turn}")
        else:
            sizes = labelled.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("elements"))
            sizes = work.table("sizes", sizes)
            pairs = work.table("pairs-across", _across(labelled.join(sizes.where(F.col("members") <= crowd).select("key"), "key"), percent))
            found = _verified(docs, pairs, names, words, percent, work, "verify-across").union(
                _crowds(docs, labelled, sizes.where(F.col("members") > crowd), names, words, percent, work))
        links = found if links is None else links.union(found)
        work.drop(f"open-{turn}")
        if labels is not None:
            work.drop(*kept)
        before = labels
        labels = work.table(f"labels-{turn}", components(links, work, f"components-{turn}"))
        kept = [f"labels-{turn - 1}"] if before is not None else []
    rows_ = signed.select("doc_id", "text_hash", "n_shingles", "class")
    if labels is None:
        return _result(rows_.join(names.select("class", F.col("doc_id").alias("least"), F.col("class").alias("group")), "class", "left"))
    grouped = names.join(labels, F.col("class") == F.col("node"), "left").select(
        "class", "doc_id", F.coalesce("root", "class").alias("root"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("least"))
    group_of = work.table("groups", grouped.join(least, "root").select("class", "least", F.col("root").alias("group")))
    return _result(rows_.join(group_of, "class", "left"))


def _result(rows: DataFrame) -> DataFrame:
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "text_hash", "group", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _labelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket rows with the component found so far, in buckets that hold several components."""
    if labels is None:
        return buckets.withColumn("root", F.col("class"))
    known = buckets.join(labels, F.col("class") == F.col("node"), "left").select(
        "key", "class", "n", F.coalesce("root", "class").alias("root"))
    several = known.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    return known.join(several, "key")


def _to_leaders(labelled: DataFrame, turn: int, percent: int) -> DataFrame:
    """One pair for each class: with the least of the leaders of its buckets."""
    order = F.struct(F.xxhash64(F.lit(turn), F.col("class")).alias("h"), "class", "n", "root")
    leaders = labelled.groupBy("key").agg(F.min(order).alias("lead"))
    offers = labelled.join(leaders, "key").where(
        (F.col("root") != F.col("lead.root")) & _alike("n", "lead.n", percent))
    return offers.groupBy(F.col("class").alias("a")).agg(F.min(F.struct("lead.h", "lead.class")).alias("lead")).select(
        "a", F.col("lead.class").alias("b"))


def _across(labelled: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that are not yet in one component; each pair once."""
    other = labelled.select("key", F.col("class").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"))
    met = labelled.join(other, "key").where((F.col("class") < F.col("b")) & (F.col("root") != F.col("other")) & _alike("n", "m", percent))
    return met.select(F.col("class").alias("a"), "b").distinct()


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents, one of each group; rows that repeat an id and text count once, rows without id all stay."""
    found = near_duplicates(docs, **options).where("kept and doc_id is not null")
    id_, hash_, text = free_names(docs, "_id", "_hash", "_text")
    chosen = found.groupBy("component_id", "group").agg(F.min(F.struct("doc_id", "text_hash")).alias("one")).select(
        F.col("one.doc_id").alias(id_), F.col("one.text_hash").alias(hash_))
    keyed = docs.where("doc_id is not null").withColumn(text, F.xxhash64("text"))
    one_each = keyed.join(chosen, (F.col("doc_id") == F.col(id_)) & (F.col(text) == F.col(hash_))).dropDuplicates([id_, hash_])
    return one_each.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def _compare(percent: int):
    """Compares two blocks of classes of a bucket; returns a tree of links for each component in them."""

    def tile(table: pa.Table) -> pa.Table:
        first, second = (table.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second"))
        rows, cols = np.flatnonzero(first), np.flatnonzero(second)
        lists = table.column("elements").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        _, name, seen = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        again = seen > 1  # an element of one set only is shared by none
        number = np.cumsum(again) - 1
        kept = again[name]
        name, owner = number[name[kept]], owner[kept]
        order = np.argsort(name, kind="stable")
        name, owner = name[order], owner[order]
        shared = np.zeros((len(rows), len(cols)), dtype=np.int64)
        for at in range(0, int(again.sum()), 2048):
            a, b = np.searchsorted(name, (at, at + 2048))
            holds = np.zeros((len(sizes), 2048), dtype=np.float32)
            holds[owner[a:b], name[a:b] - at] = 1
            shared += (holds[rows] @ holds[cols].T).astype(np.int64)  # a part's counts are exact in floats, their sum and its multiples need not be
        joint = sizes[rows][:, None] + sizes[cols][None, :] - shared
        mask = shared * 100 >= joint * percent
        if first.all() and second.all():
            np.fill_diagonal(mask, False)
            np.fill_diagonal(mask, mask.any(axis=1))
        root_a, root_b = spanning(mask)
        keys = table.column("class").to_pylist()
        links = [(keys[rows[i]], keys[rows[r]]) for i, r in enumerate(root_a) if r >= 0]
        links += [(keys[cols[j]], keys[rows[r]]) for j, r in enumerate(root_b) if r >= 0]
        return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

    return tile


def _crowds(docs: DataFrame, labelled: DataFrame, sizes: DataFrame, names: DataFrame, words: int, percent: int, work: Workspace,
            block_rows: int = 1024, block_elements: int = 1_000_000) -> DataFrame:
    """Links within large buckets, compared block by block as set matrices; no pairs leave a task."""
    blocks = F.ceil(F.greatest(F.col("members") / block_rows, F.col("elements") / block_elements)).cast("int")
    rows = labelled.select("key", "class").join(sizes.select("key", blocks.alias("blocks")), "key")
    rows = work.table("crowds", rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")))
    wanted = work.table("crowds-wanted", names.join(rows.select("class").distinct(), "class"))
    sets = work.table("crowds-sets", _sets(docs, wanted, words), TEXT_ROWS)
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    met = met.select("key", low.alias("i"), high.alias("j"), (F.col("block") == low).alias("first"), (F.col("block") == high).alias("second"), "class")
    tiles = met.join(sets, "class").groupBy("key", "i", "j").applyInArrow(_compare(percent), "a binary, b binary")
    links = work.table("crowds-links", tiles.where("a <> b").distinct())
    work.drop("crowds", "crowds-wanted", "crowds-sets")
    return links


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash", "group")


_SPACES = r"[^\x20\x09-\x0D]+"
OP2_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{_SPACES}') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN least ON least.a = doc_id
"""
