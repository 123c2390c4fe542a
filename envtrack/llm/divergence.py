"""Operator 12: how far each source's use of words is from other sources of its language.

Terms are counted inside the tasks on packed keys: a term of up to 8 bytes is one unsigned 64-bit word, one
of up to 16 bytes two; both are put in order by a radix sort of 16-bit digits and counted by runs. Longer
terms go to buckets by width (32, 64, 128, ... bytes), each sorted by its bytes. The group (lang, source)
is the last, leading digit of the sort, and as the sort is stable a run's documents stay in order, so
that the changes of document in a run are the term's document count.

Spark adds up the tasks' counts by (lang, term), keeps the terms in at least ``least`` documents of a
language, and takes the shares p = 1 + floor(10^9 (count+5) / (N+5V)) in whole numbers. Differences between
sources are summed over blocks of terms times pairs of blocks of sources, of bounded size whatever the
vocabulary and the number of sources; what the terms that no source of a block uses contribute is added
in one product.

Defined results: a null text, lang or source counts as empty; a group without terms is a group with zero
counts; a language without kept terms has pair values of 0 and no term rows; a repeated row counts
again; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envtrack.llm.common import chunks, left_join_by_key, spans, staged, text_buffer

#: Packed entries that a task holds before it merges them, and passes them on if they stay more than half.
HELD_ENTRIES = 1 << 21
#: Text counted at once, in bytes.
COUNT_BYTES = 1 << 22
#: Terms and sources of a block of the pair sums.
BLOCK_TERMS, BLOCK_SOURCES = 8192, 64
SCALE_STEP = 1000  # 10^9 is taken in three steps, so that no product leaves 64 bits

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """A stable order of rows by unsigned words, given from the least to the most significant one."""
    order = np.arange(len(words[0]))
    for word in words:
        for shift in range(0, 8 * word.itemsize, 16):
            digit = (word >> word.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _begins_run(keys: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def term_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the terms of all texts; none reaches over the end of a text."""
    letter = _LETTER[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    padded = np.concatenate([[False], letter, [False]])
    begins = np.flatnonzero(letter & (~padded[:-2] | cut[:-1]))
    ends = np.flatnonzero(letter & (~padded[2:] | cut[1:])) + 1
    return begins, ends


def width_of(lengths: np.ndarray) -> np.ndarray:
    """Each term's bucket: 8 and 16 bytes as words, then the powers of two."""
    return np.maximum(8, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))


def packed(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray, width: int) -> list[np.ndarray]:
    """The terms as sortable keys, least significant first: big-endian words, or fixed-width bytes."""
    cells = np.zeros((len(begins), width), np.uint8)
    cells[np.repeat(np.arange(len(begins)), lengths), spans(np.zeros_like(lengths), lengths)] = raw[spans(begins, lengths)]
    if width > 16:
        return [cells.view(f"S{width}").ravel()]
    return [cells[:, at:at + 8].copy().view(">u8").ravel().astype(np.uint64) for at in range(width - 8, -1, -8)]


def unpacked(keys: list[np.ndarray]) -> pa.Array:
    """The terms of packed keys as strings: no byte of a term is zero."""
    if keys[0].dtype.kind == "S":
        cells = keys[0].view(np.uint8).reshape(len(keys[0]), -1)
    else:
        cells = np.concatenate([k.astype(">u8").view(np.uint8).reshape(len(k), 8) for k in reversed(keys)], axis=1)
    used = cells != 0
    offsets = np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(cells), pa.py_buffer(offsets), pa.py_buffer(cells[used].tobytes())).cast(pa.string())


def in_order(keys: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    if keys[0].dtype.kind == "S":
        order = np.argsort(keys[0], kind="stable")
        return order[radix_order([group[order]])]
    return radix_order([*keys, group])


class TermCounts:
    """Counts (n, documents) of each (group, term) of a task, by width, merged by sorting."""

    def __init__(self):
        self.runs: dict[int, list[tuple]] = {}
        self.entries = 0

    def add_texts(self, raw: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """``group`` has each text's group number."""
        raw = _LOWER[raw]
        begins, ends = term_spans(raw, offsets)
        lengths = ends - begins
        text = np.searchsorted(offsets, begins, side="right") - 1
        width = width_of(lengths)
        for w in np.unique(width).tolist():
            here = np.flatnonzero(width == w)
            keys, owner, doc = packed(raw, begins[here], lengths[here], w), group[text[here]], text[here]
            order = in_order(keys, owner)
            keys, owner, doc = [k[order] for k in keys], owner[order], doc[order]
            new = _begins_run([*keys, owner])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(new)))
            docs = np.add.reduceat((new | _begins_run([doc])).astype(np.int64), first)
            self._hold(w, [k[first] for k in keys], owner[first], n, docs)

    def _hold(self, width, keys, owner, n, docs) -> None:
        self.runs.setdefault(width, []).append((keys, owner, n, docs))
        self.entries += len(owner)

    def merge(self) -> None:
        held, self.runs, self.entries = self.runs, {}, 0
        for width, parts in held.items():
            keys = [np.concatenate(k) for k in zip(*(p[0] for p in parts))]
            owner, n, docs = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            order = in_order(keys, owner)
            keys, owner = [k[order] for k in keys], owner[order]
            first = np.flatnonzero(_begins_run([*keys, owner]))
            self._hold(width, [k[first] for k in keys], owner[first], np.add.reduceat(n[order], first),
                       np.add.reduceat(docs[order], first))

    def take(self, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        """All that is held, as rows; afterwards nothing is held."""
        self.merge()
        held, self.runs, self.entries = self.runs, {}, 0
        langs, sources = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        for parts in held.values():
            for keys, owner, n, docs in parts:
                for a in range(0, len(owner), 1 << 16):
                    z = a + (1 << 16)
                    at = pa.array(owner[a:z].astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(at), sources.take(at), unpacked([k[a:z] for k in keys]), pa.array(n[a:z]),
                         pa.array(docs[a:z])], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n, docs: the tasks' counts, not yet added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, numbers = TermCounts(), {}
        for batch in batches:
            raw, offsets = text_buffer(batch.column(0))
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            group = np.array([numbers.setdefault(p, len(numbers)) for p in pairs], np.uint32)
            for a, z in chunks(offsets, COUNT_BYTES):
                counts.add_texts(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a], group[a:z])
                if counts.entries > HELD_ENTRIES:
                    counts.merge()
                    if counts.entries > HELD_ENTRIES // 2:
                        yield from counts.take(list(numbers))
                        numbers = {}
                        group = None
                if group is None:  # numbers begin anew with what is left of this batch
                    pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
                    group = np.array([numbers.setdefault(p, len(numbers)) for p in pairs], np.uint32)
        yield from counts.take(list(numbers))

    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col))
    return docs.select(text.alias("text"), lang.alias("lang"), source.alias("source")).mapInArrow(
        run, "lang string, source string, term string, n bigint, docs bigint")


def share(count: str, total: str) -> Column:
    """1 + floor(10^9 count / total) of two expressions, 0 <= count <= total < 2^53, exactly, in 64 bits."""
    whole, rest = "0L", f"({count})"
    for _ in range(3):
        wide = f"({rest} * {SCALE_STEP}L)"
        whole, rest = f"({whole} * {SCALE_STEP}L + {wide} div ({total}))", f"pmod({wide}, ({total}))"
    return F.expr(f"1L + {whole}")


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """lang, term, source, n, n_lang, first (one row of each term) of the terms in ``least`` documents."""
    term = Window.partitionBy("lang", "term")
    totals = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return totals.select("lang", "term", "source", "n", F.sum("docs").over(term).alias("docs"),
                         F.sum("n").over(term).alias("n_lang"),
                         (F.col("source") == F.min("source").over(term)).alias("first")).where(
        F.col("docs") >= least).drop("docs")


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """For each (lang, source): rows (kept terms in use), N, V, N of the language, and p of a term not in use."""
    of_group = kept.groupBy("lang", "source").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    of_lang = kept.where("first").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("lang_total"))
    found = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(
        0, ["rows", "total", "terms", "lang_total"])
    unused = F.when(F.col("terms") > 0, share("5L", "total + 5L * terms")).otherwise(F.lit(0))
    size = Window.partitionBy("lang")
    return found.withColumn("unused", unused).withColumn("sources", F.count("*").over(size))


def term_differences(used: DataFrame, most: int) -> DataFrame:
    """Each group's ``most`` terms whose share is furthest above the language's."""
    above = used.withColumn("q", share("n_lang + 5L", "lang_total + 5L * terms")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                        (F.col("p") - F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _block_sums(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Of each two sources of the two blocks: sum of |p-q| over the terms that either block's sources use."""
    lang, _, low, high = (k.as_py() for k in key)
    names, blocks = groups.column("source").to_pylist(), groups.column("block").to_numpy()
    unused, terms = groups.column("unused").to_numpy(), groups.column("terms").to_numpy()
    place = {name: i for i, name in enumerate(names)}
    term = rows.column("term").combine_chunks().dictionary_encode()
    share_of = np.repeat(unused[None, :], len(term.dictionary), axis=0)
    share_of[term.indices.to_numpy(), [place[s] for s in rows.column("source").to_pylist()]] = rows.column("p").to_numpy()
    left, right, value = [], [], []
    for i in range(len(names)):
        other = np.flatnonzero((blocks == (high if blocks[i] == low else low)) & (np.arange(len(names)) != i))
        left.append(np.full(len(other), i))
        right.append(other)
        value.append(np.abs(share_of[:, other] - share_of[:, i:i + 1]).sum(axis=0))
    left, right = np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])
    name = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([lang] * len(left), pa.string()), "source": name.take(pa.array(left)),
                     "item": name.take(pa.array(right)), "part_sum": np.concatenate(value or [left]).astype(np.int64),
                     "present": np.full(len(left), len(term.dictionary), np.int64), "terms": terms[left],
                     "apart": np.abs(unused[left] - unused[right])})


def pair_differences(used: DataFrame, groups: DataFrame) -> DataFrame:
    """Each group against every other source of its language: the sum of |p-q| over all kept terms."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)).cast("bigint")
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES).cast("bigint")

    def dealt(frame: DataFrame, bucket) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
        return frame.withColumn("block", F.pmod(F.xxhash64("source"), blocks)).withColumn("bucket", bucket).withColumn(
            "other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    rows = dealt(used, F.pmod(F.xxhash64("term"), buckets)).select("lang", "bucket", "low", "high", "term", "source", "p")
    present = dealt(groups, F.explode(F.sequence(F.lit(0).cast("bigint"), buckets - 1))).select(
        "lang", "bucket", "low", "high", "source", "block", "unused", "terms")
    key = ["lang", "bucket", "low", "high"]
    sums = rows.groupBy(*key).cogroup(present.groupBy(*key)).applyInArrow(
        _block_sums, "lang string, source string, item string, part_sum bigint, present bigint, terms bigint, apart bigint")
    value = F.sum("part_sum") + (F.max("terms") - F.sum("present")) * F.max("apart")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.groupBy("lang", "source", "item").agg(value.alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = 30, most: int = 50, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: the differences of each group (see the module for the rules)."""
    kept = staged(kept_terms(term_counts(docs, text_col, lang_col, source_col), least), "kept-terms")
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
    groups = docs.select(lang.alias("lang"), source.alias("source")).distinct()
    groups = staged(group_totals(groups, kept), "groups")
    used = left_join_by_key(kept, groups, ["lang", "source"], "rows").withColumn(
        "p", share("n + 5L", "total + 5L * terms"))
    return term_differences(used, most).unionByName(pair_differences(used, groups))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS body,
                  row_number() OVER () AS doc FROM documents),
o AS (SELECT lang, source, doc, translate(unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON k.lang = o.lang AND k.term = o.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source
      GROUP BY ALL),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (t.n + 5 * v.v)::HUGEINT AS p,
             1 + (1000000000 * (k.n + 5)::HUGEINT) // (v.n + 5 * v.v)::HUGEINT AS q
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang JOIN t ON t.lang = g.lang AND t.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN s x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN s y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""
