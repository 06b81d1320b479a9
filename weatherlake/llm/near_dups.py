"""MinHash near-duplicates with tensored banding.

Two small collections of ``tables`` half keys each (``width`` minhashes per
half key) are computed per document; a table key is a pair of one half key
from each collection.  ``tables ** 2`` tables thus cost ``2 * tables * width``
minhashes, a square root of what as many independent tables would cost.  With
the defaults, 144 tables of six minhashes come from 72 minhashes, and a pair
at similarity 0.8 shares no table with probability 2 * (1 - 0.8^3)^12 = 4e-4.

The flow, in which every hot key is combined before it is shuffled:

1. one pass over the texts gives every document its set size, a 64-bit
   fingerprint of its shingle set, the half keys and two sketches;
2. documents with equal sets become one class (a keyed minimum);
3. of the table keys those are made whose two half keys both occur in several
   classes; classes that share one are compared through hubs, and across
   components that are left, as ``links`` describes: no pair is made twice and
   a group of g copies does not give g * g pairs;
4. pairs whose sizes or sketches rule the similarity out are passed over: a
   parity sketch bounds the shingles that differ (exactly: no link is lost),
   and fewer than 42 of 72 equal minhashes make it next to impossible; all
   others are confirmed on the full shingle sets of both texts;
5. components of the confirmed links, by distributed star contraction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.links import hub_first, in_units, linked_groups
from weatherlake.llm.shared import Bloom, cut, modest_batches, stored, table, tidy
from weatherlake.llm.textarrays import U
from weatherlake.session import compiled_methods

TABLES, WIDTH = 12, 3
PARITIES = 1024  # buckets of the parity sketch, see _parities
LEAST_AGREEING = 42  # of 72 minhashes (and 9 of the first 24); at similarity 0.8 fewer agree once in 100,000 pairs


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after another, and
    the row ranges.  A row with fewer words than ``size`` has its whole word
    sequence as the only shingle; a row without words has none."""
    _, _, h, ranges = ta.words(data, offsets)
    mult = ta.constants(size, size) | U(1)
    whole = ta.constants(99, 1)[0]
    rolled = np.zeros(max(len(h) - size + 1, 0), U)
    for i in range(size):
        rolled += ta.mix(h[i:i + len(rolled)] * mult[i])
    rolled = ta.mix(rolled)
    parts, counts = [], np.zeros(len(ranges) - 1, np.int64)
    for r in range(len(ranges) - 1):
        a, b = ranges[r], ranges[r + 1]
        if b - a >= size:
            s = np.sort(rolled[a:b - size + 1])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            s = ta.mix(np.array([np.sum(ta.mix(h[a:b] * mult[:b - a])) ^ whole], U))
        else:
            continue
        parts.append(s)
        counts[r] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate(([0], np.cumsum(counts)))


def _fingerprints(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash per non-empty row of a set, whatever the order."""
    rows = np.flatnonzero(np.diff(at))
    out = np.zeros(len(at) - 1, U)
    if len(rows):
        out[rows] = ta.mix(np.add.reduceat(ta.mix(sets ^ U(0x1F3D)), at[rows]) + np.diff(at)[rows].astype(U))
    return out


SKETCHED = ("id long, n_shingles long, cid long, a array<long>, b array<long>, "
            + ", ".join(f"s{i} long" for i in range(2 * TABLES * WIDTH // 8)) + ", "
            + ", ".join(f"p{i} long" for i in range(PARITIES // 64)))


def _parities(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row a bit per bucket of shingles: whether it holds an odd
    number of them.  Each shingle that only one of two sets has turns one bit,
    so the bits that differ are never more than the shingles that differ."""
    rows = len(at) - 1
    bucket = np.repeat(np.arange(rows), np.diff(at)) * PARITIES + (ta.mix(sets ^ U(0x77)) >> U(54)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=rows * PARITIES) & 1).astype(np.uint8).reshape(rows, PARITIES)
    return np.ascontiguousarray(np.packbits(odd, axis=1)).view(np.int64)


def _sketcher(size: int) -> Callable:
    n = 2 * TABLES * WIDTH
    flip, mult, place = ta.constants(5, n), ta.constants(6, n) | U(1), ta.constants(7, 2 * TABLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ta.buffers(batch.column(1))
            for i, j in ta.slices(offsets):
                sets, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
                count = np.diff(at)
                full = np.flatnonzero(count)
                low = np.zeros((n, j - i), U)
                if len(full):
                    for k in range(n):
                        low[k, full] = np.minimum.reduceat((sets ^ flip[k]) * mult[k], at[full])
                half = np.stack([ta.mix(sum(ta.mix(low[t * WIDTH + w] + U(w)) for w in range(WIDTH)) ^ place[t])
                                 for t in range(2 * TABLES)]) if j > i else np.zeros((2 * TABLES, 0), U)
                sketch = np.ascontiguousarray((ta.mix(low) & U(255)).astype(np.uint8).T).view(np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * TABLES, TABLES, dtype=np.int32)),
                                                  ta.longs(np.ascontiguousarray(half[o:o + TABLES].T).ravel()))
                         for o in (0, TABLES)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(count), ta.longs(_fingerprints(sets, at)), *lists,
                     *[pa.array(np.ascontiguousarray(c)) for c in sketch.T],
                     *[pa.array(np.ascontiguousarray(c)) for c in _parities(sets, at).T]],
                    names=[f.split()[0] for f in SKETCHED.split(", ")])

    return run


def _shared_tables(known: Bloom) -> Callable:
    """Classes (cid and half keys) -> the half keys, place and class of each
    table key whose half keys both are among ``known``."""
    test = known.test()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0).to_numpy()
            a, b = (batch.column(k).flatten().to_numpy().reshape(-1, TABLES) for k in (1, 2))
            in_a, in_b = (test(x.ravel()).reshape(x.shape) for x in (a, b))
            r, i, j = np.nonzero(in_a[:, :, None] & in_b[:, None, :])
            yield pa.RecordBatch.from_arrays([pa.array(a[r, i]), pa.array(b[r, j]), pa.array((i * TABLES + j).astype(np.int32)), pa.array(node[r])],
                                             names=["x", "y", "place", "node"])

    return run


def _agreeing(left: str, right: str, words: range) -> Column:
    """How many of the sketch bytes in some of the sketch's longs agree, in bit arithmetic."""
    differing = F.lit(0)
    for i in words:
        x = F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))
        for s in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, s))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return F.lit(8 * len(words)) - differing


def first_meeting(left: str, right: str, place: str) -> Column:
    """Whether two documents that share the table at ``place`` share no
    earlier half key on either side, so that they meet there only.  It reads
    the half keys that make the table keys: a test that could take unequal
    ones for equal would pass the pair over at every table."""
    earlier = F.lit(False)
    for half, at in (("a", F.floor(F.col(place) / TABLES)), ("b", F.col(place) % TABLES)):
        for t in range(TABLES - 1):
            earlier = earlier | ((at > t) & (F.col(f"{left}.{half}")[t] == F.col(f"{right}.{half}")[t]))
    return ~earlier


def _confirmer(size: int, share: int) -> Callable:
    """Rows sorted by unit, the hub's text first: yields the members whose
    full sets meet ``100 * intersection >= share * union`` with the hub's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, hub = None, None
        for batch in batches:
            hubs, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = batch.column(2).to_pylist()
            data, offsets = ta.buffers(batch.column(3))
            links = []
            for i, j in ta.slices(offsets):
                sets, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
                prints = _fingerprints(sets, at).view(np.int64)
                for r in range(i, j):
                    s = sets[at[r - i]:at[r - i + 1]]
                    if prints[r - i] != own[r]:
                        continue  # another row with a repeated id
                    if (hubs[r], parts[r]) != unit:
                        if own[r] != hubs[r]:
                            continue
                        unit, hub = (hubs[r], parts[r]), s
                    elif own[r] != hubs[r]:
                        both = len(np.intersect1d(hub, s, assume_unique=True))
                        if 100 * both >= share * (len(hub) + len(s) - both):
                            links.append((own[r], hubs[r]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                              pa.array([x[1] for x in links], pa.int64())], names=["src", "dst"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    """The pairs (src, dst: class ids) whose full sets are similar enough."""
    rows = hub_first(in_units(pairs).join(texts, "node").select("hub", "part", "node", "text"))
    return rows.mapInArrow(tidy(_confirmer(size, share)), "src long, dst long")


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 5,
                    share: int = 80) -> DataFrame:
    """Groups of documents that are linked by word-shingle similarity.

    Words are runs of other than ASCII white space with A-Z in lower case; a
    document's set holds its distinct shingles of ``size`` words (all words as
    one shingle if there are fewer; empty without words or for a null text,
    and then linked with nothing).  Documents are linked if
    ``100 * |intersection| >= share * |union|``.

    Returns one row per input row: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest id in the group) and ``kept`` (the row's id is
    that smallest id).  Repeated rows are copies of each other.  A row with a
    null id takes part only as a copy: it gets the group of an equal set, or a
    null ``component_id`` and is kept.  An empty table gives no rows; further
    columns are ignored.
    """
    compiled_methods(docs.sparkSession)  # the tests of a pair are long conditions
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = stored(docs.mapInArrow(tidy(_sketcher(size)), SKETCHED))
    classes = stored(rows.filter("n_shingles > 0 and id is not null")
                  .select(*[c for c in rows.columns if c not in ("id", "cid")], "cid", "id")
                  .join(rows.filter("n_shingles > 0").groupBy("cid").agg(F.min("id").alias("id")), ["cid", "id"])
                  .dropDuplicates(["cid"]))
    sketch = [c for c in classes.columns if c[0] in "sp" and c[1:].isdigit()]

    # two classes share a table key only if they share both of its halves: 24 rows a class are counted, not 144
    halves = classes.select(F.explode(F.concat("a", "b")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    known = Bloom(cut(halves.filter("n > 1").select("x")), "x")
    keys = (classes.select("cid", "a", "b").mapInArrow(tidy(_shared_tables(known)), "x long, y long, place int, node long")
            .select(F.xxhash64("x", "y").alias("key"), "place", "node"))

    def plausible(p: str, q: str) -> Column:
        m, n = F.col(f"{p}.n_shingles"), F.col(f"{q}.n_shingles")
        odd = sum((F.bit_count(F.col(f"{p}.p{i}").bitwiseXOR(F.col(f"{q}.p{i}"))) for i in range(PARITIES // 64)), F.lit(0))
        # at least so similar: at most (m + n) * (100 - share) / (100 + share) shingles differ
        few = odd * (100 + share) <= (m + n) * (100 - share)
        return (F.least(m, n) * 100 >= F.greatest(m, n) * share) & few & (_agreeing(p, q, range(3)) >= 9) & (_agreeing(p, q, range(9)) >= LEAST_AGREEING)

    def texts(nodes: DataFrame) -> DataFrame:
        """One text of every class that shares a key."""
        wanted = cut(nodes.join(classes.select(F.col("cid").alias("node"), F.col("id").alias("doc")), "node"))
        some = docs.filter(Bloom(wanted.select(F.xxhash64("doc").alias("h")), "h").condition(F.xxhash64("id")))
        return wanted.join(some.select(F.col("id").alias("doc"), "text"), "doc").select("node", "text")

    groups = linked_groups(keys, classes.select(F.col("cid").alias("node"), "n_shingles", "a", "b", *sketch), plausible,
                           first_meeting, lambda pairs, material: _confirmed(pairs, material, size, share), texts)
    named = classes.select("cid", "id").join(groups.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "id", F.coalesce("component", "cid").alias("component"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = cut(named.join(least, "component").select("cid", "component_id"))
    out = rows.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("cid")).alias("cid")).join(of_class, "cid", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.col("component_id").isNull()).alias("kept"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


# lower() of every letter but A-Z must leave the text alone, so the letters are translated
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
         ELSE [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] END) AS sh FROM w
), n AS (SELECT doc_id, len(sh) AS n FROM s
), e AS (SELECT doc_id, unnest(sh) AS g FROM s
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p
), r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""
