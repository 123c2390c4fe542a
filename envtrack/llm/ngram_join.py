"""Operator 6: n-gram Jaccard self-join with Bayesian candidate pruning.

1. Each text gives the set of its word n-grams (five words, lower case, split at white space; a text of
   fewer words is one n-gram), the set's digest, and MinHash values. Texts with equal sets are copies
   of one class and represented by one row from here on.
2. Texts that share a band of MinHash values are candidates. Within a bucket, values are compared 16 at
   a time; a pair is dropped when the posterior probability that its similarity reaches the threshold
   (uniform prior) falls below the tolerance. Of the pairs that stay only a spanning forest is passed
   on: texts already connected through a common text are not compared again.
3. The connected components of those pairs are clusters. Within each cluster, every pair of different
   texts is verified exactly on the whole n-gram sets, block against block; a text's links are counted
   where they are found and never written as pairs.
4. The components of the verified links are the classes.

Buckets and clusters are cut into blocks of bounded rows and n-grams, one task's group is one pair of
blocks, so that no group is gathered whole; keys that hold many rows are joined by broadcast
(``left_join_by_key``). The texts are read twice: n-gram sets travel only for documents of a cluster.

Defined results: null and empty texts and texts of white space have no n-grams and link to nothing;
repeated rows are copies; ids are compared as they are, null ids are never the smallest; an empty table
gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack.llm.common import chunks, components, left_join_by_key, numbered, spans, staged, text_buffer
from envtrack.llm.exact_dedup import occupied_bits
from envtrack.llm.words import word_hashes

#: MinHash values, values of a band, and values compared in one step.
VALUES, BAND, STEP = 64, 4, 16
TOLERANCE = 1e-5
#: Rows of a block of a bucket, and rows and n-grams of a block of a cluster: what a task settles at once is a
#: pair of blocks, so that these bound the work and not only the memory.
BUCKET_ROWS, BLOCK_ROWS, BLOCK_GRAMS = 1024, 512, 3 << 19
#: Pairs compared directly, and texts of an n-gram that are paired directly rather than by a product.
DIRECT_PAIRS, DIRECT_TEXTS = 1 << 20, 16

_rng = np.random.default_rng(1905)
PLACE = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(np.uint64) | np.uint64(1)
MINHASH = _rng.integers(1, 2**63, VALUES, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct word n-grams, ascending, text after text; and how many each has."""
    bodies = [" ".join(t.lower().split()).encode() for t in texts]
    size = np.array([len(b) + 1 for b in bodies], np.int64)
    raw = np.frombuffer(b" ".join(bodies) + b" ", np.uint8)  # each word is followed by one blank
    gap = np.flatnonzero(raw == 32)
    start = np.append(0, gap[:-1] + 1)
    word = _finish(word_hashes(raw, start, gap))
    owner = np.searchsorted(np.cumsum(size), start, side="right")
    real = gap > start  # an empty text leaves an empty word
    word, owner = word[real], owner[real]
    words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(words) - words
    grams = np.where(words >= n, words - n + 1, (words > 0).astype(np.int64))
    at = spans(first, grams)
    of = np.repeat(np.arange(len(texts)), grams)
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        inside = np.minimum(words[of] + first[of] - 1, at + k)
        value += np.where(at + k == inside, word[inside] if len(word) else 0, np.uint64(0)) * PLACE[k]
    value = _finish(value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.bincount(of[new], minlength=len(texts))


def digests(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    data, ends = values.tobytes(), np.append(0, np.cumsum(counts)) * 8
    return [hashlib.blake2b(data[a:z], digest_size=16).digest() for a, z in zip(ends.tolist(), ends[1:].tolist())]


def minhash(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """VALUES MinHash values (32 bits) of each non-empty set; zeros for an empty one."""
    out = np.zeros((len(counts), VALUES), np.uint32)
    full = np.flatnonzero(counts)
    start = (np.cumsum(counts) - counts)[full]
    for k in range(VALUES if len(full) else 0):
        out[full, k] = np.minimum.reduceat((values * MINHASH[k]) >> np.uint64(32), start)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    bands = signature.reshape(len(signature), -1, BAND).astype(np.uint64)
    mixed = np.zeros(bands.shape[:2], np.uint64)
    for k in range(BAND):
        mixed = _finish(mixed * PLACE[40] + bands[:, :, k] + PLACE[41])
    return _finish(mixed + PLACE[np.arange(bands.shape[1])]).view(np.int64)


@functools.lru_cache(maxsize=4)
def least_matches(threshold: float) -> tuple[int, ...]:
    """After 16, 32, ... values: the matches below which the posterior is under the tolerance.

    With a uniform prior and m matches of n, P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        chance, m = 0.0, -1
        while chance < TOLERANCE:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out.append(m)
    return tuple(out)


def surviving(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Places of the pairs that no step drops."""
    keep = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for k, need in enumerate(least):
        step = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (sig[left[keep], step] == sig[right[keep], step]).sum(axis=1, dtype=np.int32)
        stay = matches >= need
        keep, matches = keep[stay], matches[stay]
    return keep


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each node's component."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
        while not (label[label] == label).all():
            label = label[label]
    return label


def connect(sig: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Roots of one large bucket block: hubs first, then whatever the largest group left out."""
    n = len(sig)
    label, rest = np.arange(n), np.arange(n)
    for _ in range(16):  # groups around hubs; the loop only saves work, all pairs are settled below
        if len(rest) < 2:
            break
        near = rest[1:][surviving(sig, np.full(len(rest) - 1, rest[0]), rest[1:], least)]
        label[near] = rest[0]
        rest = rest[1:][~np.isin(rest[1:], near)]
    common = np.bincount(label, minlength=n).argmax()
    outside = np.flatnonzero(label != common)
    edges_l, edges_r = [np.arange(n)], [label]
    rows = max(1, (1 << 18) // n)
    for a in range(0, len(outside), rows):
        some = outside[a:a + rows]
        matches = np.zeros((len(some), n), np.uint8)
        for k in range(STEP):
            matches += sig[some, k][:, None] == sig[None, :, k]
        i, j = np.nonzero((matches >= least[0]) & (label[some][:, None] != label[None, :]))
        i = some[i]
        good = surviving(sig, i, j, least)
        edges_l.append(i[good])
        edges_r.append(j[good])
    return roots(n, np.concatenate(edges_l), np.concatenate(edges_r))


def by_group(batches: Iterator[pa.RecordBatch], keys: int, most_rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows with equal first ``keys`` columns: (table, bounds of the groups in it)."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, last: bool):
        columns = [table.column(k).to_numpy() for k in range(keys)]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        bounds = np.append(np.flatnonzero(new), table.num_rows)
        return bounds if last else bounds[:-1]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < most_rows:
            continue
        table = pa.Table.from_batches(held)
        bounds = cut(table, False)
        if len(bounds) > 1:
            yield table.slice(0, bounds[-1]), bounds
        held = table.slice(bounds[-1]).to_batches()
    if held and sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        yield table, cut(table, True)


def binary_matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(column), width)


def _measured(docs: DataFrame, n: int, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                texts = batch.column(1).slice(a, z - a).fill_null("").to_pylist()
                values, counts = gram_sets(texts, n)
                sig = minhash(values, counts)
                names = digests(values, counts)
                keys = band_keys(sig)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array(names, pa.binary()), pa.array(counts, pa.int64()),
                     pa.array([r.tobytes() for r in (sig & np.uint32(255)).astype(np.uint8)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()),
                                              keys.ravel()), batch.column(2).slice(a, z - a)],
                    names=["id", "digest", "grams", "sig", "bands", "row"])

    kind = docs.schema[id_col].dataType.simpleString()
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), row.alias("row"))
    return rows.mapInArrow(
        run, f"id {kind}, digest binary, grams bigint, sig binary, bands array<bigint>, row bigint")


def _paired_blocks(rows: DataFrame, group: str) -> DataFrame:
    """Each row once for every pair of blocks of its group that its block ``b`` of ``nb`` is in."""
    other = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    paired = other.withColumns({"lo": F.least("b", "o").cast("int"), "hi": F.greatest("b", "o").cast("int")})
    keys = [group, "lo", "hi"]
    return paired.repartition(*keys).sortWithinPartitions(*keys)


def _candidates(texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a spanning forest of the pairs that Bayesian pruning keeps."""
    least = least_matches(threshold)
    buckets = texts.select("digest", F.explode("bands").alias("key"))
    total = texts.count() * (VALUES // BAND)
    sizes = staged(buckets.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    heavy, light = sizes.where(F.col("m") > total / 1024), sizes.where(F.col("m") <= total / 1024)
    rest = buckets.join(F.broadcast(heavy), "key", "left_anti")  # no row of a heavy bucket is shuffled by its key
    rows = buckets.join(F.broadcast(heavy), "key").unionByName(rest.join(light, "key"))
    rows = rows.withColumn("nb", F.ceil(F.col("m") / BUCKET_ROWS).cast("int"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("digest"), "nb").cast("int")).drop("m")
    rows = rows.join(texts.select("digest", "sig"), "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in by_group(batches, 3, 1 << 14):
            sig = binary_matrix(table.column("sig"), VALUES)
            names = table.column("digest").combine_chunks()
            size = np.diff(bounds)
            label = np.arange(table.num_rows)
            small = size * (size - 1) // 2 <= DIRECT_PAIRS // 8
            later = np.repeat(bounds[1:], size) - np.arange(table.num_rows) - 1
            later[np.repeat(~small, size)] = 0
            cut = np.append(0, np.cumsum(later))
            left, right, a = [], [], 0
            while a < table.num_rows:  # the pairs of small groups, so many at a time
                z = max(a + 1, int(np.searchsorted(cut, cut[a] + DIRECT_PAIRS, side="right")) - 1)
                i = np.repeat(np.arange(a, z), later[a:z])
                j = spans(np.arange(a, z) + 1, later[a:z])
                good = surviving(sig, i, j, least)
                left.append(i[good])
                right.append(j[good])
                a = z
            label = roots(table.num_rows, np.concatenate(left), np.concatenate(right))
            for g in np.flatnonzero(~small):
                label[bounds[g]:bounds[g + 1]] = bounds[g] + connect(sig[bounds[g]:bounds[g + 1]], least)
            tied = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(tied)), names.take(pa.array(label[tied]))],
                                             names=["a", "b"])

    ordered = _paired_blocks(rows, "key").select("key", "lo", "hi", "digest", "sig")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right`` (None: the same)."""
    sets = left if right is None else left + right
    split = len(left)
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    held = np.diff(np.append(first, len(value)))
    out = np.zeros((split, len(sets) - split if right is not None else split), np.float32)
    width = out.shape[1]
    shift = split if right is not None else 0

    few = (held > 1) & (held <= DIRECT_TEXTS)  # an n-gram of few texts: its pairs, one by one
    for a in range(0, int(few.sum()), 1 << 16):
        begin, count = first[few][a:a + (1 << 16)], held[few][a:a + (1 << 16)]
        place = spans(begin, count)
        later = np.repeat(begin + count, count) - place - 1
        i, j = owner[np.repeat(place, later)], owner[spans(place + 1, later)]
        if right is not None:
            cross = (i < split) & (j >= split)
            i, j = i[cross], j[cross]
        np.add.at(out.reshape(-1), i * width + j - shift, np.float32(1))
        if right is None:
            np.add.at(out.reshape(-1), j * width + i, np.float32(1))
    many = np.flatnonzero(held > DIRECT_TEXTS)  # all others: a matrix product, some n-grams at a time
    for a in range(0, len(many), 512):
        begin, count = first[many[a:a + 512]], held[many[a:a + 512]]
        flags = np.zeros((len(sets), len(begin)), np.float32)
        flags[owner[spans(begin, count)], np.repeat(np.arange(len(begin)), count)] = 1
        out += flags[:split] @ (flags if right is None else flags[split:]).T
    return out


def verified(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs have at least the threshold, exactly; a set is no pair with itself."""
    shared = overlaps(left, right)
    n, m = (np.array([len(s) for s in x], np.float64) for x in (left, left if right is None else right))
    link = shared * (1 + threshold) >= threshold * (n[:, None] + m[None, :]) - 1e-7
    if right is None:
        np.fill_diagonal(link, False)
    return link


def _links(docs: DataFrame, texts: DataFrame, clusters: DataFrame, n: int, threshold: float,
           text_col: str) -> DataFrame:
    """digest, other (a spanning forest of the links), links and text_links of each linked text."""
    sizes = clusters.join(texts.select("digest", "grams", "copies", "fingerprint"), "digest")
    sizes = staged(sizes, "cluster-texts")
    spread = sizes.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS),
                                                  F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("nb"),
                                        F.count("*").alias("members"))
    placed = left_join_by_key(sizes, staged(spread, "cluster-blocks"), "root", "members")
    placed = placed.select("digest", "root", "copies", "nb", F.pmod(F.xxhash64("digest"), "nb").cast("int").alias("b"))
    route, vector = occupied_bits(sizes, 64)
    shared = docs.sparkSession.sparkContext.broadcast(vector)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffer(batch.column(0))
            seen: set[bytes] = set()
            for a, z in chunks(offsets):
                values, counts = gram_sets(batch.column(0).slice(a, z - a).fill_null("").to_pylist(), n)
                names = digests(values, counts)
                index = (np.frombuffer(b"".join(names), ">u8")[::2] >> np.uint64(64 - route)).astype(np.int64)
                hit = (shared.value[index >> 5] >> (index & 31).astype(np.uint32)) & np.uint32(1)
                ends = np.append(0, np.cumsum(counts)).tolist()
                out = []
                for i in np.flatnonzero(hit).tolist():
                    if names[i] not in seen:
                        seen.add(names[i])
                        out.append((names[i], values[ends[i]:ends[i + 1]].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)],
                                                     names=["digest", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in by_group(batches, 3, 1 << 10):
            rows: list[tuple[bytes, bytes, int, int]] = []
            block, names = table.column("b").to_numpy(), table.column("digest").to_pylist()
            copies, lo, hi = (table.column(c).to_numpy() for c in ("copies", "lo", "hi"))
            grams = table.column("grams").combine_chunks()
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                once = list({names[i]: i for i in range(a, z)}.values())  # a text may come from several batches
                if lo[a] == hi[a]:
                    parts = [once]
                else:
                    parts = [[i for i in once if block[i] == lo[a]], [i for i in once if block[i] == hi[a]]]
                if not all(parts) or len(once) < 2:
                    continue
                left, right = ([np.frombuffer(grams[i].as_buffer(), "<u8") for i in p]
                               for p in (parts + [parts[0]])[:2])
                link = verified(left, None if len(parts) == 1 else right, threshold)
                i, j = np.nonzero(link)
                p, q = np.array(parts[0]), np.array(parts[-1])
                label = roots(z - a, p[i] - a, q[j] - a)
                sides = [(p, link)] if len(parts) == 1 else [(p, link), (q, link.T)]
                for (own, hits), other in zip(sides, (q, p)):
                    count = hits.sum(axis=1)
                    weight = hits @ copies[other]
                    for k in np.flatnonzero(count).tolist():
                        rows.append((names[own[k]], names[a + label[own[k] - a]], int(weight[k]), int(count[k])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64(), pa.int64()))],
                    names=["digest", "other", "links", "text_links"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(sets, "digest binary, grams binary")
    ordered = _paired_blocks(found.join(placed, "digest"), "root")
    return ordered.select("root", "lo", "hi", "digest", "grams", "copies", "b").mapInArrow(
        run, "digest binary, other binary, links bigint, text_links bigint")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, words: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """For each document: id, class_id, n_links, n_text_links, copies, kept.

    class_id: the smallest id of the class (the document's own id if it links to nothing). n_links: the
    other documents, copies included, with at least the threshold. n_text_links: the other texts. kept:
    true for one document of each class, the first of those with the smallest id. ``row_col`` names a
    column of unique row numbers, if there is one; it is returned as well.
    """
    measured = staged(_measured(docs, words, id_col, text_col, row_col), "grams")
    lead = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint")
    texts = measured.where("grams > 0").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"),
        F.first("grams").alias("grams"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands")).withColumn("fingerprint", lead)
    texts = staged(texts, "texts")
    forest = staged(_candidates(texts, threshold), "candidates")
    clusters = staged(components(forest, "a", "b").withColumnRenamed("node", "digest"), "clusters")
    found = staged(_links(docs, texts, clusters, words, threshold, text_col), "links")
    counts = found.groupBy("digest").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    classes = components(found, "digest", "other").withColumnRenamed("node", "digest")
    whole = staged(texts.select("digest", "copies", "least").join(counts, "digest", "left")
                   .join(classes, "digest", "left").withColumn("root", F.coalesce("root", "digest")), "text-classes")
    smallest = staged(whole.groupBy("root").agg(F.min("least").alias("first"), F.count("*").alias("members")), "class-ids")
    whole = left_join_by_key(whole, smallest, "root", "members").select("digest", "copies", "first", "links", "text_links")
    real = F.col("grams") > 0
    rows = measured.select("id", "digest", "grams", "row")
    out = left_join_by_key(rows.where(real), staged(whole, "text-results"), "digest", "copies")
    out = out.unionByName(rows.where(~real), allowMissingColumns=True)  # all of one digest, which no text has
    return out.select(
        F.col("id").alias(id_col), F.when(real, F.col("first.id")).otherwise(F.col("id")).alias("class_id"),
        F.when(real, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("bigint").alias("n_links"),
        F.coalesce("text_links", F.lit(0)).cast("bigint").alias("n_text_links"),
        F.when(real, F.col("copies")).otherwise(1).cast("bigint").alias("copies"),
        (~real | (F.col("row") == F.col("first.row"))).alias("kept"),
        *([F.col("row").alias(row_col)] if row_col else []))


def one_of_each_class(docs: DataFrame, threshold: float = 0.8, words: int = 5, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, that stay when one document of each class does."""
    rows, row = numbered(docs)
    kept = near_duplicates(rows, threshold, words, id_col, text_col, row).where("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)
