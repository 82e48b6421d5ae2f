"""Merkle manifest of a table: a leaf digest per row, a subroot per group, one root, and proofs.

Method: lag/lead windows. The nodes of a level are numbered within their group. Every
``fan`` consecutive nodes form a run; a window partitioned by group and run gives each
node fixed-offset ``lag`` and ``lead`` columns, masked by its slot in the run and the
run's length: they supply its siblings, and the first child of each run hashes the
parent. Levels repeat while a group holds more than one node; the last node is the
group's subroot. The subroots, numbered in group order, form a tree of the same kind
whose last node is the root. Proofs are then passed down the same levels: each node
joins its parent by (group, run), so no key holds more than ``fan`` rows, however large
a group is.

Digests are lowercase hex SHA-256; a parent is the digest of its children's hex digests
concatenated as text. A run of one node still becomes its digest; a lone node of a level
is not hashed again.

Defined cases: rows are ordered in their group by the order column, nulls first, and equal
values by leaf digest, so repeated rows are interchangeable leaves; a null group is a group
of its own, first in group order (then UTF-8 bytewise); an empty table gives an empty
result; a check digest that is null counts as the leaf itself. Input columns whose names
begin with ``__`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.columns import without
from sievemark.llm.prefix import running_totals
from sievemark.llm.scratch import scratch_path

FAN = 16
#: Groups counted up to this many are broadcast to the rows; more are joined by a shuffle.
BROADCAST_GROUPS = 1_000_000
RESULT = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def field(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:``, and the value as text."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of the fields of a row, concatenated."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _key(group: Column) -> Column:
    # Never null, and in the order of the group: null first, then UTF-8 bytewise.
    return F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))


def _runs(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes (``__g``, ``__pos``, ``__h``, ``__n``) with their run, slot and siblings' digests."""
    nodes = nodes.withColumn("__run", F.expr(f"__pos div {fan}")).withColumn("__slot", F.col("__pos") % fan)
    slot = F.col("__slot")
    length = F.least(F.lit(fan).cast("long"), F.col("__n") - F.col("__run") * fan)
    run = Window.partitionBy("__g", "__run").orderBy("__slot")
    left = [F.when(slot >= k, F.lag("__h", k).over(run)) for k in range(fan - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("__h", k).over(run)) for k in range(1, fan)]
    return nodes.withColumn("__left", F.concat_ws("", *left)).withColumn("__right", F.concat_ws("", *right))


def _levels(nodes: DataFrame, fan: int) -> list[DataFrame]:
    """Node tables from the given level up; a group's last node has ``__n`` 1.

    Each level is written to the shared folder: the next reads it, and so does the
    pass that hands proofs down.
    """
    spark = nodes.sparkSession
    levels = [nodes]
    most = nodes.agg(F.max("__n")).first()[0] or 0
    while most > 1:
        ran = _runs(levels[-1].where(F.col("__n") > 1).select("__g", "__pos", "__h", "__n"), fan)
        parents = ran.where(F.col("__slot") == 0).select(
            "__g",
            F.col("__run").alias("__pos"),
            F.sha2(F.concat("__h", "__right"), 256).alias("__h"),
            F.ceil(F.col("__n") / fan).cast("long").alias("__n"),
        )
        path = scratch_path(spark, "merkle-level")
        parents.write.parquet(path)
        levels.append(spark.read.parquet(path))
        most = -(-most // fan)
    return levels


def _down(levels: list[DataFrame], above: DataFrame, fan: int, carried: Sequence[str]) -> DataFrame:
    """The nodes of the lowest level with ``__suffix``: (left, right) siblings from there up.

    ``above`` holds, per group, the suffix of its last node and the ``carried`` columns.
    Each node also gets ``__top``: the digest of its group's last node.
    """
    spark = levels[0].sparkSession
    parent = None
    for depth in reversed(range(len(levels))):
        level = levels[depth]
        lone = level.where(F.col("__n") == 1).join(above, "__g").withColumn("__top", F.col("__h"))
        if parent is None:
            here = lone
        else:
            up = parent.select(
                "__g", F.col("__pos").alias("__run"), F.col("__suffix").alias("__up"), "__top", *carried
            )
            sibling = F.array(F.struct(F.col("__left").alias("l"), F.col("__right").alias("r")))
            many = (
                _runs(level.where(F.col("__n") > 1), fan)
                .join(up, ["__g", "__run"])
                .withColumn("__suffix", F.concat(sibling, "__up"))
                .drop("__up", "__run", "__slot", "__left", "__right")
            )
            here = lone.unionByName(many)
        if depth:
            path = scratch_path(spark, "merkle-proofs")
            here.select("__g", "__pos", "__suffix", "__top", *carried).write.parquet(path)
            parent = spark.read.parquet(path)
        else:
            parent = here
    return parent


def _positions(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """``__pos``: the rank of a row in its group by ``order``, from distributed prefix sums."""
    ranked = running_totals(rows.withColumn("__one", F.lit(1)), [F.col(group), *order], "__one", "__pos", group=group)
    return ranked.drop("__one")


def manifest(rows: DataFrame, group: Column, order: Column, digest: Column, check: Column | None = None, fan: int = FAN) -> DataFrame:
    """Add ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``digest`` is each row's leaf; ``check`` a digest to verify in its place (default: the
    leaf). ``proof_sha256`` digests the siblings of all levels, bottom up, each run's
    others left to right; ``folded_root`` recomputes the root from the check digest and
    those siblings, and ``verified`` tells whether it equals the root.
    """
    spark = rows.sparkSession
    kept = without(rows, *RESULT).columns
    base = rows.select(
        *kept,
        _key(group).alias("__g"),
        digest.alias("__h"),
        F.coalesce(check if check is not None else digest, digest).alias("__check"),
        order.alias("__order"),
    )
    placed = _positions(base, "__g", [F.col("__order").asc_nulls_first(), F.col("__h")])
    counts = placed.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    n_groups = counts.count()
    if n_groups <= BROADCAST_GROUPS:
        counts = F.broadcast(counts)
    path = scratch_path(spark, "merkle-leaves")
    placed.join(counts, "__g").write.parquet(path)
    leaves = spark.read.parquet(path)

    per_group = _levels(leaves, fan)
    lone = [level.where(F.col("__n") == 1).select(F.col("__g").alias("__member"), "__h") for level in per_group]
    subroots = lone[0]
    for more in lone[1:]:
        subroots = subroots.unionByName(more)
    subroots = _positions(subroots.withColumn("__g", F.lit("")), "__g", [F.col("__member")])
    top = _levels(subroots.withColumn("__n", F.lit(n_groups).cast("long")), fan)
    empty = F.array().cast("array<struct<l:string,r:string>>")
    above_top = spark.range(1).select(F.lit("").alias("__g"), empty.alias("__suffix"))
    members = _down(top, F.broadcast(above_top), fan, []).select(
        F.col("__member").alias("__g"), "__suffix", F.col("__top").alias("__root")
    )
    found = _down(per_group, members, fan, ["__root"])

    proof = F.sha2(F.array_join(F.transform("__suffix", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    folded = F.aggregate("__suffix", F.col("__check"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    return found.select(
        *kept,
        F.col("__h").alias("leaf"),
        F.col("__top").alias("subroot"),
        F.col("__root").alias("root"),
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("__root")).alias("verified"),
    )
