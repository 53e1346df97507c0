"""Near duplicates by MinHash with tensored banding, confirmed on full shingle sets.

A table of plain banding needs ``k`` minhashes of its own.  Here two collections of
``SIDE`` short hashes (``ROWS`` minhashes each) are made, and every pair of a short
hash from the first and one from the second is the key of a table: ``2 * SIDE * ROWS``
minhashes serve ``SIDE ** 2`` tables of ``2 * ROWS`` rows.  With 16 and 3, 96 minhashes
serve 256 tables, and two documents of similarity 0.75 meet in one of them with
probability ``(1 - (1 - 0.75 ** 3) ** 16) ** 2`` = 0.9997 (0.8: 0.99998).

1. Documents with equal sets are one class (its smallest id stands for it).
2. A short hash that no other class has cannot be part of a shared key; only the rest
   are combined to keys.
3. In every bucket the smallest member is paired with each other one: as many pairs as
   members.  Pairs whose set sizes allow the similarity are confirmed on full sets.
4. Members of buckets that are then still in several components are brought together by
   the short hash from the first collection that they share, so each document travels
   ``SIDE`` times at most.  Within a task all of them are compared on full sets, and one
   link per document and component goes on.  No link that a bucket shows is lost, and
   groups of near copies are not expanded into all their pairs.  Large groups are
   compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from newslake.llm.common import map_batches, pick, rows_of_ids, write
from newslake.llm.components import connected

WORDS = 5
PERCENT = 75
ROWS, SIDE = 3, 16
#: Members of a group that are compared at a time.
BLOCK_ROWS = 512
#: Documents that are hashed at a time.
DOCS_AT_ONCE = 256
#: Word hashes that a Python worker remembers at most.
WORD_ENTRIES = 1 << 18

_RANDOM = np.random.default_rng(20_240_901)
_FACTORS = _RANDOM.integers(1 << 62, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_MASKS = _RANDOM.integers(0, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64)
_ODD = _RANDOM.integers(1 << 62, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        self[word] = value = xxh3_64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def forget() -> None:
    """Called at the end of a task."""
    WORD_HASHES.clear()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles.

    Words lie between ASCII white space, A-Z in lower case; a text of fewer words
    than a shingle is one shingle, a text without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _FACTORS[i]
    return np.unique(mixed(total))


def short_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``2 * SIDE`` combined minhashes per non-empty set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    combined = np.empty((len(sets), 2 * SIDE), np.uint64)
    for place in range(2 * SIDE):
        total = np.full(len(sets), place, np.uint64)
        for n in range(place * ROWS, (place + 1) * ROWS):
            total = mixed(total + np.minimum.reduceat((values ^ _MASKS[n]) * _ODD[n], starts))
        combined[:, place] = total
    return combined


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for at in range(0, batch.num_rows, DOCS_AT_ONCE):
        part = batch.slice(at, DOCS_AT_ONCE)
        yield part.column("id"), [shingles(t) for t in part.column("text").to_pylist()]


def _lists(values: list[np.ndarray] | np.ndarray) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if len(values) else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, flat.view(np.int64))


def _signatures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    names = ["id", "n", "shape", "short"]
    for ids, sets in _parts(batch):
        rows = [i for i, s in enumerate(sets) if len(s)]
        short: list[np.ndarray] = [np.empty(0, np.uint64)] * len(sets)
        if rows:
            for i, row in zip(rows, short_hashes([sets[i] for i in rows]), strict=True):
                short[i] = row
        sizes = pa.array([len(s) for s in sets], pa.int64())
        shapes = pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([ids, sizes, shapes, _lists(short)], names)


def _sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for ids, sets in _parts(batch):
        yield pa.RecordBatch.from_arrays([ids, _lists(sets)], ["id", "items"])


def _shared_hashes(classes: DataFrame) -> DataFrame:
    """``id, n, own``: of every class the short hashes that another class has as well."""
    spark = classes.sparkSession
    rows = classes.select("id", "n", F.posexplode("short").alias("place", "hash"))
    shared = write(rows.groupBy("place", "hash").agg(F.count("*").alias("c")).filter("c > 1").drop("c"), "short")
    kept = rows.join(spark.read.parquet(shared), ["place", "hash"])
    own = kept.groupBy("id", "n").agg(F.collect_list(F.struct("place", "hash")).alias("own"))
    return own


def _table_rows(own: DataFrame) -> DataFrame:
    """``key, first, id, n``: one row per table in which a class may meet another one.

    ``first`` is the part of the key that comes from the first collection.
    """
    left = F.filter("own", lambda x: x["place"] < SIDE)
    right = F.filter("own", lambda x: x["place"] >= SIDE)
    one = lambda x, y: F.struct(F.xxhash64(x, y).alias("key"), F.xxhash64(x).alias("first"))
    tables = F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: one(x, y))))
    return own.select(F.inline(tables), "id", "n")


def _may_link(n: str, m: str):
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("of_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("items").alias("of_a")), "a"
    )
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter(common * 100 >= union * PERCENT).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col, n_shingles long, component_id, kept boolean``.

    Documents are linked when their sets of distinct five-word shingles have a Jaccard
    similarity of 0.75 or more; a component is all that links reach, named by its
    smallest id, and that document is kept.  Shingles are compared as 64-bit hashes,
    equal sets are recognised by a 128-bit digest.

    Null and empty texts have no shingles and link with nothing.  A row without an id
    links with nothing either: its ``component_id`` is null and it is kept.  Rows that
    share an id count as one document for what they reach, and each gets a row.  An
    empty table gives an empty one.  Other columns are left out, whatever their names.
    """
    spark = df.sparkSession
    docs = pick(df, id=id_col, text=text_col)
    schema = f"id {dict(docs.dtypes)['id']}, n long, shape binary, short array<long>"
    signed = write(map_batches(docs, _signatures, schema, forget), "signatures")
    rows = spark.read.parquet(signed)
    classes = (
        rows.filter("n > 0 AND id IS NOT NULL")
        .groupBy("shape")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("short").alias("short"))
    )
    members = spark.read.parquet(write(_table_rows(_shared_hashes(classes)), "buckets"))
    heads = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("head"), F.count("*").alias("c"))
    heads = spark.read.parquet(write(heads.filter("c > 1").select("key", "head"), "heads"))
    met = members.join(heads, "key")
    # The texts are shuffled at every size alike: what is looked up grows with them.
    named = met.select("id").distinct().hint("merge")
    texts = docs.join(named, "id", "left_semi")
    # Of rows that share an id some may be without a text; their empty sets link with nothing.
    full = map_batches(texts, _sets, f"id {dict(docs.dtypes)['id']}, items array<long>", forget).filter(F.size("items") > 0)
    sets = write(full, "sets")
    sets = spark.read.parquet(sets)
    stars = (
        met.filter(F.col("id") != F.col("head.id"))
        .filter(_may_link("n", "head.n"))
        .select(F.col("head.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    links = spark.read.parquet(write(_confirmed(stars, sets), "confirmed"))
    joined = connected(links)
    more = spark.read.parquet(write(_across_components(members, joined, sets), "across"))
    roots = connected(joined.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more))

    named = classes.select("shape", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("shape", F.coalesce("root", "id").alias("root"))
    # Equal sets may be a third of all rows: both sides are written, so their join can be split.
    known = spark.read.parquet(write(named, "classes"))
    found = rows.select("id", "n", "shape").join(known, "shape", "left")
    component = F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("root"))).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The whole rows of one document per component; documents without words all stay."""
    kept = near_duplicates(docs, id_col, text_col).filter("kept").select(id_col)
    return rows_of_ids(docs, id_col, kept.distinct())


def _across_components(members: DataFrame, joined: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between components that meet in a bucket."""
    spark = members.sparkSession
    labelled = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "first", "id", F.coalesce("root", "id").alias("root")
    )
    rows = spark.read.parquet(write(labelled, "labelled"))
    several = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y")
    several = spark.read.parquet(write(several.select("key"), "several"))
    open_rows = rows.join(several, "key", "left_semi").select("first", "id", "root").distinct()
    open_rows = spark.read.parquet(write(open_rows, "open"))
    sizes = open_rows.groupBy("first").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = spark.read.parquet(write(sizes, "sizes"))
    facing = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    block = F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")
    dealt = open_rows.join(sizes, "first").select("first", "id", "root", block, facing.alias("other"))
    groups = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    groups = groups.join(sets, "id").repartition("first", "i", "j").sortWithinPartitions("first", "i", "j")
    kind = dict(members.dtypes)["id"]
    return groups.mapInArrow(_compare, f"a {kind}, b {kind}").distinct()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; groups may go over the ends of batches."""
    key, rows, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field("id").type
        items = batch.column("items")
        values, offsets = items.values.to_numpy(zero_copy_only=False), items.offsets.to_numpy()
        columns = [batch.column(c).to_pylist() for c in ("first", "i", "j", "id", "root", "block")]
        for n, (*group, doc, root, block) in enumerate(zip(*columns, strict=True)):
            if group != key:
                yield from _links(key, rows, kind)
                key, rows = group, []
            rows.append((doc, root, block, values[offsets[n] : offsets[n + 1]].copy()))
    yield from _links(key, rows, kind)


def _links(key: list | None, rows: list[tuple], kind: pa.DataType | None) -> Iterator[pa.RecordBatch]:
    """One link from each document of one group to each other component it is linked with."""
    if len(rows) < 2:
        return
    ids, named, block, items = zip(*rows, strict=True)
    places: dict = {}
    roots = np.array([places.setdefault(r, len(places)) for r in named])
    block, sizes = np.array(block), np.fromiter(map(len, items), np.int64, len(items))
    _, place = np.unique(np.concatenate(items), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(place, kind="stable")
    holders, first = owner[order], np.searchsorted(place[order], np.arange(place.max() + 2))
    ends = np.cumsum(sizes)
    largest = np.bincount(roots).argmax()
    a, b = [], []
    for r in np.flatnonzero(roots != largest):
        mine = place[ends[r] - sizes[r] : ends[r]]
        counts = first[mine + 1] - first[mine]
        upto = np.cumsum(counts)
        at = np.arange(upto[-1]) + np.repeat(first[mine] - upto + counts, counts)
        common = np.bincount(holders[at], minlength=len(rows))
        linked = (100 * common >= PERCENT * (sizes + sizes[r] - common)) & (roots != roots[r])
        if key[1] != key[2]:
            linked &= block != block[r]
        linked = np.flatnonzero(linked)
        for other in linked[np.unique(roots[linked], return_index=True)[1]]:
            a.append(ids[r])
            b.append(ids[other])
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])
