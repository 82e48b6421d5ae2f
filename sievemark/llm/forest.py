"""Near-duplicates by an LSH forest: sorted signature orders, neighbours as candidates.

A document is the set of its distinct 3-word shingles. Equal sets are one
representative. Each representative gets a minhash signature, and every tree of the
forest sorts all representatives by another order of its positions. Neighbours that
share a prefix of at least ``MIN_DEPTH`` values are candidates; how deep the shared
prefix runs is what the data around them makes it, so crowded regions separate deeper
than sparse ones. Sorting is by range, so a crowded region spans many tasks.

Candidates are confirmed on the full shingle sets. Confirmed links merge components,
and the next round pairs every document with its nearest neighbours *outside its own
component*, best candidates first, until no candidate is left untried: a large group
of near copies costs a few links per member, and members still find partners beyond
the copies around them. What is then left is finished exactly: the rows of all regions
that still hold several components meet across components on their rarest shingles,
which two sets of the wanted similarity must share, and pairs for which the rest of
both sets cannot suffice are left out. So every link whose ends share a prefix in any
tree is found. With 24 trees a link at 0.85 fails to share a prefix in all of them with
probability 2e-8.

Defined cases: no words or a null text means an empty set, linked with nothing; texts
shorter than three words are one shingle; repeated rows and repeated ids fall into one
component by their sets; an empty table gives an empty result; extra columns are not
read, names beginning with ``__`` are reserved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.components import components
from sievemark.llm.texts import document_words, mixed
from sievemark.llm.scratch import scratch_path

TREES = 24
MIN_DEPTH = 4
TREE_DEPTH = 10
HASHES = TREES * MIN_DEPTH
_SET_BYTES = 5  # shingle hashes are kept to 40 bits in stored sets
BROADCAST_IDS = 2_000_000
BLOCK = 256  # sets that are listed shingle by shingle at a time

_generator = np.random.default_rng(8512)
_SCALE = _generator.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _generator.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_STEP = _generator.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, width: int = 3) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column."""
    for _, hashes, bounds in document_words(column):
        n = len(hashes)
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            rolled[: max(0, n - k)] += hashes[k:] * _STEP[k]
        rolled = mixed(rolled)
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if end - begin >= width:
                yield np.unique(rolled[begin : end - width + 1])
            elif end > begin:
                short = hashes[begin:end] * _STEP[: end - begin]
                yield mixed(np.array([short.sum(dtype=np.uint64) + np.uint64(end - begin)], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minhash values, 24 bits each."""
    low = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512, None] * _SCALE + _SHIFT
        np.minimum(low, part.min(axis=0), out=low)
    return (mixed(low) >> np.uint64(40)).astype(np.uint32)


def _signed(documents: DataFrame, keys: list[str], text: str, width: int) -> DataFrame:
    """Per row: its keys, set size, digest of the set, packed signature (null for an empty set)."""
    carried = documents.select(*keys, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, packed = [], [], []
            for shingles in shingle_sets(batch.column(len(keys)), width):
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                packed.append(signature(shingles).astype(">u4").tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                names=[*keys, "n_shingles", "set_key", "sig"],
            )

    return carried.mapInArrow(run, f"{schema}, n_shingles long, set_key binary, sig binary")


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _tree_rows(representatives: DataFrame) -> DataFrame:
    """One row per tree and representative: its signature in that tree's order."""
    orders = (np.arange(TREES)[:, None] * MIN_DEPTH + np.arange(TREE_DEPTH)) % HASHES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint8).reshape(-1, HASHES, 4)
            keys = packed[:, orders.T, 1:]  # documents x depth x tree x three bytes
            keys = np.ascontiguousarray(keys.transpose(2, 0, 1, 3)).reshape(-1, TREE_DEPTH * 3)
            n = batch.num_rows
            ids = np.tile(batch.column("rep").to_numpy(), TREES)
            trees = np.repeat(np.arange(TREES, dtype=np.int32), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees), _binary(keys), pa.array(ids)], names=["tree", "key", "rep"]
            )

    return representatives.select("rep", "sig").mapInArrow(run, "tree int, key binary, rep long")


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _depths(trees: np.ndarray, keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows ``left`` and ``right``, in values; 0 across trees."""
    same = (keys[left] == keys[right]).all(axis=2)
    return np.where(trees[left] == trees[right], np.logical_and.accumulate(same, axis=1).sum(axis=1), 0)


def _sorted_scan(rows: DataFrame, schema: str, emit) -> DataFrame:
    """Range-sort rows by tree and key, and let ``emit`` see them in stretches that overlap by one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.Table.from_batches([batch])
            whole = own if carried is None else pa.concat_tables([carried, own])
            keep = emit.tail(whole)
            yield from emit.rows(whole, keep)
            carried = whole.slice(keep)
        if carried is not None and carried.num_rows:
            yield from emit.rows(carried, carried.num_rows)

    return rows.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep").mapInArrow(run, schema)


class _Regions:
    """Keeps rows that share a deep enough prefix with the row before or after."""

    def tail(self, table: pa.Table) -> int:
        return table.num_rows - 1 if table.num_rows > 1 else 0

    def rows(self, table: pa.Table, end: int) -> Iterator[pa.RecordBatch]:
        trees, keys = _columns(table)
        n = len(trees)
        near = np.zeros(n, dtype=bool)
        if n > 1:
            close = _depths(trees, keys, np.arange(n - 1), np.arange(1, n)) >= MIN_DEPTH
            near[1:] |= close
            near[:-1] |= close
        # A carried row is seen twice; a second copy only stands next to itself.
        if table.num_rows:
            yield from table.filter(pa.array(near)).combine_chunks().to_batches()


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    trees = table.column("tree").to_numpy()
    flat = np.frombuffer(b"".join(table.column("key").to_pylist()), dtype=np.uint8)
    return trees, flat.reshape(len(trees), -1, 3)


def _region_rows(rows: DataFrame) -> DataFrame:
    """Rows in regions of at least two."""
    return _sorted_scan(rows, "tree int, key binary, rep long", _Regions())


class _Neighbours:
    """Pairs every row with the nearest row before and behind it that has another component."""

    def tail(self, table: pa.Table) -> int:
        """Stretches end at a change of component, or of region."""
        comps, trees = table.column("comp").to_numpy(), table.column("tree").to_numpy()
        change = np.flatnonzero((comps[1:] != comps[:-1]) | (trees[1:] != trees[:-1])) + 1
        return int(change[-1]) if len(change) else 0

    def rows(self, table: pa.Table, end: int) -> Iterator[pa.RecordBatch]:
        trees, keys = _columns(table)
        comps, reps = table.column("comp").to_numpy(), table.column("rep").to_numpy()
        n = len(trees)
        if n < 2:
            return
        starts = np.flatnonzero(np.r_[True, (comps[1:] != comps[:-1]) | (trees[1:] != trees[:-1])])
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
        left, right = [], []
        ahead = np.flatnonzero(run + 1 < len(starts))
        left.append(ahead)
        right.append(starts[run[ahead] + 1])
        behind = np.flatnonzero(run > 0)
        left.append(starts[run[behind]] - 1)
        right.append(behind)
        a, b = np.concatenate(left), np.concatenate(right)
        depth = _depths(trees, keys, a, b)
        ok = depth >= MIN_DEPTH
        a, b, depth = reps[a[ok]], reps[b[ok]], depth[ok]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(depth.astype(np.int32))], names=["a", "b", "depth"]
        )


def _candidates(regions: DataFrame, comps: DataFrame) -> DataFrame:
    """Distinct candidate pairs of different components, with the depths they share in all trees summed."""
    placed = regions.join(comps, "rep")
    pairs = _sorted_scan(placed.select("tree", "key", "rep", "comp"), "a long, b long, depth int", _Neighbours())
    return pairs.groupBy("a", "b").agg(F.sum("depth").alias("depth"))


def _crowded(regions: DataFrame, comps: DataFrame) -> DataFrame:
    """``rep`` and ``comp`` of the rows of regions that still hold several components."""
    rows = regions.select("tree", F.substring("key", 1, 3 * MIN_DEPTH).alias("prefix"), "rep").distinct().join(comps, "rep")
    counted = rows.groupBy("tree", "prefix").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    several = counted.where(F.col("low") < F.col("high")).select("tree", "prefix")
    return rows.join(several, ["tree", "prefix"], "left_semi").select("rep", "comp").distinct()


def _rarest(crowded: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of every crowded set: ``rep, comp, n, token, place`` (from 1, rarest first).

    Two sets that reach ``percent`` have a shingle in common among the first
    ``n - percent * n + 1`` of each, in any order that holds for all of them. Shingles
    of one crowded set only come first and meet nothing, so they are counted, not listed.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                own = [_unpack(p).astype(np.int64) for p in part.column("packed").to_pylist()]
                sizes = [len(o) for o in own]
                same = [np.repeat(part.column(c).to_numpy(), sizes) for c in ("rep", "comp", "key")]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, same), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(own))], names=[*whose, "token"]
                )

    whose = ["rep", "comp", "key", "n"]
    # Repeated rows have one set, and rows that repeat an id may have several.
    distinct = sets.join(crowded, "rep").withColumn("key", F.xxhash64("packed")).dropDuplicates(["rep", "key"])
    tokens = distinct.mapInArrow(opened, "rep long, comp long, key long, n long, token long")
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    listed = tokens.join(common, "token").groupBy(*whose).agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("s"))
    alone = F.col("n") - F.size("s")
    reach = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    head = F.slice("s", F.lit(1), F.greatest(reach - alone, F.lit(0)).cast("int"))
    placed = listed.select("rep", "comp", "n", alone.alias("alone"), F.posexplode(head).alias("at", "t"))
    return placed.select("rep", "comp", "n", F.col("t.token").alias("token"), (F.col("alone") + F.col("at") + 1).alias("place"))


def _across(rarest: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs across components that share one of their rarest shingles and may reach ``percent``.

    What is left of both sets from the shared shingle on must suffice. Of the component
    that has most rows of a shingle, rows meet only those of others, not each other.
    """
    per_comp = rarest.groupBy("token", "comp").agg(F.count("*").alias("rows"))
    main = per_comp.groupBy("token").agg(F.max(F.struct("rows", "comp"))["comp"].alias("main"), F.count("*").alias("k"))
    open_ = rarest.join(main.where(F.col("k") > 1).drop("k"), "token")
    side = lambda name: [F.col(c).alias(f"{c}_{name}") for c in ("rep", "comp", "n", "place")]
    left = open_.where(F.col("comp") != F.col("main")).select("token", "main", *side("x"))
    right = open_.select("token", *side("y"))
    rest = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y")) + 1
    met = left.join(right, "token").where(
        (F.col("comp_x") != F.col("comp_y"))
        & ((F.col("comp_y") == F.col("main")) | (F.col("rep_x") < F.col("rep_y")))
        & ((100 + percent) * rest >= percent * (F.col("n_x") + F.col("n_y")))
    )
    return met.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def _stored_sets(documents: DataFrame, wanted: DataFrame, order: str, text: str, width: int) -> DataFrame:
    """Packed shingle sets of the wanted representatives (``rep`` and the digest of its set)."""
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    chosen = documents.select(F.col(order).cast("long").alias("rep"), F.col(text).alias("__text")).join(side, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, same = [], []
            for shingles, key in zip(shingle_sets(batch.column(1), width), batch.column(2).to_pylist()):
                same.append(len(shingles) > 0 and hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == key)
                cut = np.unique(shingles & np.uint64((1 << 8 * _SET_BYTES) - 1))
                packed.append(cut.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SET_BYTES].tobytes())
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["rep", "packed"])
            yield rows.filter(pa.array(same, pa.bool_()))

    return chosen.select("rep", "__text", "set_key").mapInArrow(run, "rep long, packed binary")


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // _SET_BYTES, 8), dtype=np.uint8)
    wide[:, :_SET_BYTES] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, _SET_BYTES)
    return wide.view("<u8").ravel()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity: 100 * common >= percent * union."""
    left = sets.select(F.col("rep").alias("a"), F.col("packed").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("packed").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                n, m = len(x) // _SET_BYTES, len(y) // _SET_BYTES
                if 100 * min(n, m) < percent * max(n, m):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(_unpack(x), _unpack(y), assume_unique=True))
                keep.append(100 * common >= percent * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(run, "a long, b long")


def _best(pairs: DataFrame, per_document: int | None) -> DataFrame:
    """The deepest candidates of each document; a pair counts for its first member."""
    if per_document is None:
        return pairs
    if per_document == 1:
        top = pairs.groupBy("a").agg(F.max(F.struct("depth", (-F.col("b")).alias("back"))).alias("m"))
        return top.select("a", (-F.col("m.back")).alias("b"), F.col("m.depth").alias("depth"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("depth"), "b"))
    return pairs.withColumn("__rank", rank).where(F.col("__rank") <= per_document).drop("__rank")


def near_duplicates(
    documents: DataFrame, order: str = "doc_id", text: str = "text", percent: int = 85, width: int = 3
) -> DataFrame:
    """Per row: ``n_shingles`` and ``component_id``, the smallest id reachable over links.

    ``order`` is an integer id. A row with an empty set, or without an id, is its own component.
    """
    signed = _written(_signed(documents, [order], text, width), "signed")
    by_set = _components_of_sets(signed, documents, order, text, percent, width)
    joined = signed.select(order, "n_shingles", "set_key").join(by_set, "set_key", "left")
    return joined.select(order, "n_shingles", F.coalesce("__comp", F.col(order).cast("long")).alias("component_id"))


def keep_one(
    documents: DataFrame, order: str = "doc_id", text: str = "text", percent: int = 85, width: int = 3
) -> DataFrame:
    """The rows of ``documents`` without near copies: of each component the row with the smallest id.

    Rows with an empty set or without an id all stay. Of rows that repeat an id within
    a component one stays. Only ids and digests decide; texts move once, to be joined.
    """
    rows = _written(documents.withColumn("__row", F.monotonically_increasing_id()), "rows")
    signed = _written(_signed(rows, [order, "__row"], text, width), "signed")
    by_set = _components_of_sets(signed, rows, order, text, percent, width)
    placed = signed.select(order, "__row", "set_key").join(by_set, "set_key", "left")
    # Among rows of the smallest id the first row stays.
    first = placed.where(F.col("__comp").isNotNull() & F.col(order).isNotNull()).groupBy("__comp").agg(F.min(F.struct(F.col(order), F.col("__row"))).alias("m"))
    chosen = first.select(F.col("m.__row").alias("__row"))
    loose = placed.where(F.col("__comp").isNull() | F.col(order).isNull()).select("__row")
    return rows.join(chosen.union(loose), "__row", "left_semi").select(*documents.columns)


def _components_of_sets(
    signed: DataFrame, documents: DataFrame, order: str, text: str, percent: int, width: int
) -> DataFrame:
    """``set_key`` and ``__comp`` of every non-empty set."""
    filled = signed.where(F.col("set_key").isNotNull() & F.col(order).isNotNull())
    least = filled.groupBy("set_key").agg(F.min(F.struct(F.col(order).cast("long").alias("rep"), "sig", "n_shingles")).alias("m"))
    representatives = _written(least.select("set_key", "m.rep", "m.sig", "m.n_shingles"), "representatives")
    regions = _written(_region_rows(_tree_rows(representatives.select("rep", "sig"))), "regions")
    labels = _link_all(documents, representatives, regions, order, text, percent, width)
    by_set = representatives.select("set_key", "rep").join(labels, "rep", "left")
    return by_set.select("set_key", F.coalesce("comp", "rep").alias("__comp"))


def _link_all(
    documents: DataFrame, representatives: DataFrame, regions: DataFrame, order: str, text: str, percent: int, width: int
) -> DataFrame:
    comps = regions.select("rep").distinct().withColumn("comp", F.col("rep"))
    comps = _written(comps, "comps")
    if comps.isEmpty():
        return comps
    wanted = _written(representatives.select("rep", "set_key").join(comps.select("rep"), "rep", "left_semi"), "wanted")
    sets = _written(_stored_sets(documents, wanted, order, text, width), "sets")
    tried: DataFrame | None = None
    # First one candidate per document, then some, then all that still lie between components.
    for batch in chain((1, 8), repeat(None)):
        open_pairs = _candidates(regions, comps)
        if tried is not None:
            open_pairs = open_pairs.join(tried, ["a", "b"], "left_anti")
        chosen = _written(_best(open_pairs, batch), "chosen")
        if chosen.isEmpty():
            break
        tried = chosen.select("a", "b") if tried is None else tried.union(chosen.select("a", "b"))
        comps = _linked(comps, chosen, sets, percent)
    # Then all pairs across components that could be links, among the rows of regions that hold several.
    crowded = _written(_crowded(regions, comps), "crowded")
    if crowded.isEmpty():
        return comps
    open_pairs = _across(_written(_rarest(crowded, sets, percent), "rarest"), percent)
    if tried is not None:
        open_pairs = open_pairs.join(tried, ["a", "b"], "left_anti")
    return _linked(comps, _written(open_pairs, "chosen"), sets, percent)


def _linked(comps: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components after the confirmed ones among ``pairs`` are joined."""
    links = _written(_confirmed(pairs, sets, percent), "links")
    if links.isEmpty():
        return comps
    left = comps.select(F.col("rep").alias("a"), F.col("comp").alias("u"))
    right = comps.select(F.col("rep").alias("b"), F.col("comp").alias("v"))
    merged = components(links.join(left, "a").join(right, "b").select("u", "v"))
    moved = comps.join(merged.select(F.col("node").alias("comp"), F.col("root")), "comp", "left")
    return _written(moved.select("rep", F.coalesce("root", "comp").alias("comp")), "comps")
