"""Operator 6: near-duplicate documents by MinHash.

A document's set is that of its distinct runs of ``words`` words. Documents with equal word sequences are one class,
so copies are never compared. For each class: ``bands * rows`` minima under universal hash functions, cut into bands;
classes that agree in a band share a bucket. Candidate pairs are checked by size and by their signatures, and what is
left is confirmed exactly on the full sets. Components of the confirmed links come from alternating star steps.

No bucket is expanded into all its pairs. Each round compares a bucket's members with one pivot, links what is
confirmed, and goes on only with buckets whose members are still in different components: first the lowest number
in the bucket, then a pseudo-random member (another one in each bucket). What is still open after that is compared
inside groups of bounded size, which return links between components and no pairs: every member outside the largest
component is intersected with all others. Then every candidate pair is either in one component or was compared, so the
components are those of all candidate pairs.

Every step is keyed by class or bucket with map-side aggregation; the joins have sides that adaptive execution can
split. Sets travel only for classes that share a bucket with another one. They are made in a second scan that is
filtered by a bitmap of fixed size (``BITMAP_BITS``, 1 MB broadcast whatever the corpus).

With 32 bands of 4, a pair at the threshold shares no band once in 190,000 times (0.684 ** 32), and more similar pairs
more rarely; the signature check drops a true link once in millions (five standard deviations).

Defined results: null and empty texts, and texts of blanks only, have an empty set and are linked with nothing; a text
of fewer words than a run has one element, its whole sequence. Each row is its own document, repeated rows included:
they are copies, and rows with equal ids have equal results. A component's id is its smallest non-null doc_id (null if
there is none); ``kept`` is whether the row's id is that id, nulls being equal. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import ROW, by_batch, raw_bytes, set_aside, slices, written
from aislewise.llm.components import components
from aislewise.llm.ranges import salted_join

WORDS, BANDS, ROWS = 5, 32, 4
DIGEST = "__digest"
NUMERATOR, DENOMINATOR = 75, 100
# A pair at the threshold agrees in 0.75 of 128 minima with a standard deviation of 0.038; this is 5 of them below.
SIGNATURE_FLOOR = 0.56
BITMAP_BITS = 1 << 23
CHUNK, CHUNK_BYTES = 500, 16_000_000  # members of a bucket, and bytes of their sets, that a group holds twice at most
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
REMEMBERED = 100_000  # word hashes a worker keeps; only speed depends on it


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of 2-universal multiply-add-shift hashes of 32-bit values."""
    draw = np.random.default_rng(20_240_601)
    return tuple(draw.integers(1, 2**64 - 1, size=(2, count, 1), dtype=np.uint64))


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > REMEMBERED:
        known.clear()
    for w in {x for x in words if x not in known}:
        known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: list[bytes], known: dict[bytes, int], size: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of ``size`` words, or of the whole if it is shorter."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = word_hashes(words, known)
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = (h ^ w[i : len(w) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(items: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of each hash function over the items, in blocks that bound memory."""
    a, b = functions
    x = items >> np.uint64(32)
    least = np.full(len(a), 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(x), 4096):
        np.minimum(least, (x[None, i : i + 4096] * a + b).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def split_words(text: bytes) -> list[bytes]:
    """Words between ASCII blanks, A-Z in lower case."""
    return text.translate(LOWER).split()


def class_key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def profiles(docs: DataFrame, bands: int, rows: int, size: int, *passed: str) -> DataFrame:
    """(doc_id, class, n, signature) of every row, and columns ``passed``; class and signature are null without words."""

    known: dict[bytes, int] = {}  # of a task: it gets its own copy of this function
    functions = hash_functions(bands * rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[bytes, tuple[int, bytes]] = {}
        keys, counts, signatures = [], [], []
        for text in raw_bytes(batch.column(1)):
            words = split_words(text)
            key = class_key(words) if words else None
            if words and key not in seen:
                items = shingles(words, known, size)
                seen[key] = (len(items), signature(items, functions).tobytes())
            n, s = seen[key] if words else (0, None)
            keys.append(key)
            counts.append(n)
            signatures.append(s)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *batch.columns[2:],
                pa.array(keys, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", *passed, "class", "n", "signature"],
        )

    schema = docs.select("doc_id", *passed).schema.add("class", "binary").add("n", "long").add("signature", "binary")
    return by_batch(docs.select("doc_id", "text", *passed), work, schema)


def bitmap(bits: DataFrame) -> np.ndarray:
    """Which of BITMAP_BITS bit numbers occur in column ``bit``: summed up per bucket of the built-in bitmap, 1 MB."""
    parts = (
        bits.groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits"))
        .collect()
    )
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for p in parts:
        chunk = np.frombuffer(bytes(p.bits), dtype=np.uint8)
        at = (p.part - 1) * len(chunk)
        out[at : at + len(chunk)] = chunk[: len(out) - at]
    return out


def bit_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BITMAP_BITS))


def full_sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(no, n, signature, items) of ``classes``, from the rows whose id is the first of such a class."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(classes.select(bit_of(F.col("first_id")).alias("bit"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = shared.value, {}
        for batch in batches:
            bit = batch.column(1).to_numpy()
            wanted = pa.array(((held[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool))
            for part in slices(batch.filter(wanted)):
                words = [split_words(t) for t in raw_bytes(part.column(0))]
                words = [w for w in words if w]
                sets = [shingles(w, known, size).tobytes() for w in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(class_key, words), pa.binary()), pa.array(sets, pa.binary())], ["class", "items"]
                )

    sets = docs.select("text", bit_of(F.col("doc_id")).alias("bit")).mapInArrow(work, "class binary, items binary")
    # Rows that repeat an id and a text give equal sets: one of them stays.
    return sets.dropDuplicates(["class"]).join(classes.select("no", "class", "n", "signature"), "class").drop("class")


def agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose signatures agree often enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(batch.num_rows, -1)
            for c in ("signature_a", "signature_b")
        )
        keep = pa.array((x == y).mean(axis=1) >= SIGNATURE_FLOOR)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    sized = pairs.where(f"least(n_a, n_b) * {DENOMINATOR} >= greatest(n_a, n_b) * {NUMERATOR}")
    return by_batch(sized.select("a", "b", "signature_a", "signature_b"), work, "a long, b long")


def confirmed(pairs: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= 75 * union."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return by_batch(pairs.select("a", "b", "items_a", "items_b"), work, "a long, b long")


def with_sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        names = [F.col(c).alias(f"{c}_{side}") for c in columns]
        pairs = pairs.join(table.select(F.col("no").alias(side), *names), side)
    return pairs


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among candidate pairs (a, b)."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = written(agreeing(with_sides(pairs, sets, "n", "signature")))
    return written(confirmed(with_sides(likely, sets, "items")))


def placed(busy: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, no, c) of the buckets whose members are in several components c of ``links``."""
    found = components(links).withColumnRenamed("node", "no")
    rows = busy.join(found, "no", "left").select("bucket", "no", F.coalesce("component", "no").alias("c"))
    open_ = rows.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket")
    return written(rows.join(open_, "bucket"))


def connect(group: list[tuple[int, int, bytes, bytes]]) -> list[tuple[int, int]]:
    """Links (a, b) that join the components c of a group's members (no, c, signature, items).

    Every member outside the largest component is compared with all members of other components: signatures first,
    and full sets of those that may reach the threshold, whole lists of them at once by counting common shingles.
    """
    no, c = [x[0] for x in group], np.unique([x[1] for x in group], return_inverse=True)[1]
    signatures = np.array([np.frombuffer(x[2], "<u4") for x in group])
    items = [np.frombuffer(x[3], np.uint64) for x in group]
    sizes = np.array([len(x) for x in items])
    place = c.copy()  # merged components
    out = []
    for q in np.flatnonzero(c != np.bincount(c).argmax()).tolist():
        fits = (np.minimum(sizes, sizes[q]) * DENOMINATOR >= np.maximum(sizes, sizes[q]) * NUMERATOR) & (place != place[q])
        others = np.flatnonzero(fits)
        others = others[(signatures[others] == signatures[q]).mean(axis=1) >= SIGNATURE_FLOOR]
        if not len(others):
            continue
        every = np.concatenate([items[x] for x in others])
        at = np.minimum(np.searchsorted(items[q], every), sizes[q] - 1)
        holder = np.repeat(np.arange(len(others)), sizes[others])
        common = np.bincount(holder[items[q][at] == every], minlength=len(others))
        near = DENOMINATOR * common >= NUMERATOR * (sizes[q] + sizes[others] - common)
        for x in others[near].tolist():
            if place[x] != place[q]:
                out.append((no[q], no[x]))
                place[place == place[x]] = place[q]
    return out


def closing_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components c of open buckets (bucket, no, c), from the full sets of their members.

    A bucket is cut into chunks of bounded count and bytes, and each pair of chunks is a group. A group returns at most
    one link for two components that it joins, so the output is linear, however many pairs a bucket has. Groups are
    runs of sorted rows, of which a task holds one at a time; most are small, and one call per group would cost more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, bytes, bytes]] = []
        at = None
        for batch in itertools.chain(batches, [None]):
            links: list[tuple[int, int]] = []
            columns = [c.to_pylist() for c in batch.columns] if batch is not None else [[None]] * 7
            for *key, no, c, signature, items in zip(*columns):
                if key != at:
                    links += connect(group) if len({x[1] for x in group}) > 1 else []
                    group, at = [], key
                group.append((no, c, signature, items))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    weighed = rows.join(sets.select("no", "n"), "no").groupBy("bucket")
    weighed = weighed.agg(
        F.ceil(F.greatest(F.count("*") / F.lit(CHUNK), F.sum("n") * 8 / F.lit(CHUNK_BYTES))).cast("int").alias("chunks")
    )
    mine = F.pmod(F.xxhash64("no", "bucket"), F.col("chunks")).cast("int").alias("mine")
    spread = rows.join(weighed, "bucket").select("*", mine)
    spread = spread.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    spread = spread.select("bucket", "no", "c", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    members = spread.join(sets.select("no", "signature", "items"), "no")
    key = ["bucket", "i", "j"]
    rows = members.select(*key, "no", "c", "signature", "items").repartition(*key).sortWithinPartitions(*key)
    return rows.mapInArrow(run, "a long, b long")


def linked(busy: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect whatever any candidate pair connects; ``busy`` has the (bucket, no) rows of shared buckets."""
    pivots = busy.groupBy("bucket").agg(F.min("no").alias("b"))
    links = verify(busy.join(pivots, "bucket").select(F.col("no").alias("a"), "b"), sets)

    rows = placed(busy, links)
    if not rows.isEmpty():
        # The least of number xor bucket is another member in each bucket, and gives the number back.
        mixed = F.expr("no ^ bucket")
        pivots = rows.groupBy("bucket").agg(F.min(mixed).alias("mixed")).select("bucket", F.expr("mixed ^ bucket").alias("b"))
        pivots = pivots.join(rows.select("bucket", F.col("no").alias("b"), F.col("c").alias("c_b")), ["bucket", "b"])
        pairs = rows.join(pivots, "bucket").where("c <> c_b").select(F.col("no").alias("a"), "b")
        links = written(links.unionByName(verify(pairs, sets)))
        rows = placed(busy, links)

    if not rows.isEmpty():
        links = links.unionByName(written(closing_links(rows, sets)))
    return links


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    return groups(docs, bands, rows, words).select("doc_id", "n_shingles", "component_id", "kept")


def representatives(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """One row of ``docs`` for each group: its first row of the smallest id. Groups are told apart by the number of their
    component, so texts that are not linked stay, whatever ids they share.

    Rows without words stand alone; those equal in id and text are one document. Only ids, class keys and text digests are
    shuffled to choose; the texts are joined once.
    """
    plain, back = set_aside(docs, ROW)
    numbers = written(plain.withColumn(ROW, F.monotonically_increasing_id()))
    digest = F.unhex(F.md5("text"))
    found = groups(numbers.select("doc_id", "text", ROW, digest.alias(DIGEST)), bands, rows, words, ROW, DIGEST)
    # Kept rows of one component have one id.
    alone = F.when(F.col("class").isNull(), F.struct("doc_id", DIGEST))
    chosen = found.where("kept").groupBy("component", alone.alias("alone")).agg(F.min(ROW).alias(ROW)).select(ROW)
    return numbers.join(chosen, ROW, "left_semi").select(*back)


def groups(docs: DataFrame, bands: int, rows: int, words: int, *passed: str) -> DataFrame:
    """doc_id, class, component, n_shingles, component_id, kept and the columns ``passed`` of every row. The number
    ``component`` is null without words."""
    profile = written(profiles(docs, bands, rows, words, *passed))
    classes = profile.where("class IS NOT NULL").groupBy("class")
    classes = classes.agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("signature").alias("signature")
    )
    classes = written(classes.withColumn("no", F.monotonically_increasing_id()))

    band = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substr("signature", i * (4 * rows) + 1, F.lit(4 * rows))),
    )
    buckets = classes.select(F.explode(band).alias("bucket"), "no")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    busy = written(buckets.join(shared, "bucket"))
    candidates = classes.join(busy.select("no").distinct(), "no", "left_semi")
    sets = written(full_sets(docs, written(candidates), words))

    found = components(linked(busy, sets))
    # The smallest id of each component, from its classes.
    named = classes.select("no", "class", "first_id").join(found.withColumnRenamed("node", "no"), "no")
    least = named.groupBy("component").agg(F.min("first_id").alias("least_id"))
    grouped = named.join(least, "component").select("class", "component", "least_id")
    of_class = classes.select("class", "no", "first_id").join(grouped, "class", "left").select(
        "class", F.coalesce("component", "no").alias("component"), F.coalesce("least_id", "first_id").alias("of_class")
    )
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("of_class"))
    # A class of very many copies is one key: its rows are dealt out by a number besides.
    out = salted_join(profile.select("doc_id", "class", "n", *passed), of_class, ["class"], "left")
    return out.select(
        "doc_id",
        "class",
        "component",
        *passed,
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
