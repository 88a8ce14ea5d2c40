"""A Merkle manifest of a table: trees per group, a tree over their roots, and a proof for each row.

Nodes are labelled by the interval of leaf ranks they cover. Level l's nodes cover ``fan_out ** l``
ranks each (the last one of a tree fewer), so a node's parent lies in the bucket that its first rank
falls into at the next level, and holds the node's interval. A node's siblings are those of the
parent's children whose intervals lie in the parent's interval without the node's own. Paths are
handed down from the roots: each level is joined once, and it has ``fan_out`` times as many rows as
the one above, so all joins together move little more than the last, which attaches the leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchside.llm.common import Scratch

c = F.col

FAN_OUT = 8
#: The columns that make a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every n-th row by the checksum of its key is held against a tampered text.
TAMPERED = 3
#: A step of a path: what the node's siblings before and after it add to the parent's digest.
PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*[x.cast("binary") for x in parts]), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' count, ``:``, and the value as text."""
    text = value.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(told, F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[field(x) for x in fields])


def folded(start: Column, path: Column) -> Column:
    """The digest at the end of ``path``, begun with ``start``."""
    return F.aggregate(path, start, lambda at, step: digest(step["before"], at, step["after"]))


def proof(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    told = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return digest(F.array_join(told, ""))


def ranked(leaves: DataFrame, tree: str, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Adds ``lo`` (a leaf's rank in its tree, from 0) and ``n`` (the tree's leaves).

    Rows are range-partitioned by tree and order, so a tree of any size is split, and numbered by the
    tasks that write them; the counts of the ranges before a row are added then.
    """
    keys = [tree, *order]
    split = scratch.store(
        leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        "manifest-ranges",
    )
    # The number holds the partition above its low 33 bits and the place in it below.
    split = split.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per tree and range that holds a part of it.
    parts = scratch.store(
        split.groupBy(tree, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .select(
            c(tree).alias("_tree"), c("_part").alias("_in"), "_first",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy(tree)).alias("n"),
        ),
        "manifest-parts",
    )
    here = c(tree).eqNullSafe(c("_tree")) & (c("_part") == c("_in"))
    place = (c("_at") - c("_first") + c("_before")).alias("lo")
    return split.join(parts, here).select(*leaves.columns, place, "n")


@dataclass
class Forest:
    """The nodes of all trees by level; level 0 holds the leaves."""

    tree: str
    levels: list[DataFrame]

    def bucket(self, level: int) -> Column:
        """The bucket of that level in which a node's first rank lies."""
        return F.expr(f"lo div {FAN_OUT**level}L")

    def tops(self) -> DataFrame:
        """The node of each tree that covers all its leaves: tree, n, level and digest."""
        found = [
            rows.where("hi - lo = n").select(self.tree, "n", F.lit(i).alias("level"), "digest")
            for i, rows in enumerate(self.levels)
        ]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def paths(self, tops: DataFrame, carry: Sequence[str]) -> DataFrame:
        """Each leaf's row with the ``carry`` of its tree's row in ``tops``.

        ``tops`` has the tree, ``level``, ``path`` (what lies above the tree's root) and ``carry``;
        ``path`` of the result leads from the leaf to its end.
        """
        above = None
        for level in range(len(self.levels) - 1, -1, -1):
            rows = self.levels[level]
            side = tops.where(c("level") == level).select(
                c(self.tree).alias("_tree"), c("path").alias("_above"), *carry
            )
            # One row per tree on either side.
            found = rows.where("hi - lo = n").join(side, c(self.tree).eqNullSafe(c("_tree")))
            found = found.withColumn("path", c("_above")).drop("_tree", "_above")
            if above is not None:
                inner = rows.where("hi - lo < n").withColumn("_bucket", self.bucket(level + 1))
                outer = above.select(
                    c(self.tree).alias("_tree"), self.bucket(level + 1).alias("_in"),
                    c("lo").alias("_lo"), c("hi").alias("_hi"), c("children").alias("_children"),
                    c("path").alias("_above"), *carry,
                )
                # The bucket brings a node to one parent, whose interval contains its own.
                inside = (
                    c(self.tree).eqNullSafe(c("_tree")) & (c("_bucket") == c("_in"))
                    & (c("_lo") <= c("lo")) & (c("hi") <= c("_hi"))
                )
                # What the parent's interval holds besides the node's own.
                before = F.filter("_children", lambda x: x["hi"] <= c("lo"))
                after = F.filter("_children", lambda x: x["lo"] >= c("hi"))
                step = F.struct(
                    F.array_join(F.transform(before, lambda x: x["digest"]), "").alias("before"),
                    F.array_join(F.transform(after, lambda x: x["digest"]), "").alias("after"),
                )
                path = F.concat(F.array(step).cast(PATH), c("_above"))
                joined = inner.join(outer, inside).withColumn("path", path)
                found = found.unionByName(joined.select(found.columns))
            above = found
        return above


def forest(leaves: DataFrame, tree: str, scratch: Scratch) -> Forest:
    """The trees over ranked ``leaves``: rows with ``tree``, ``n``, ``lo`` and ``digest``.

    Every level is one grouping of at most ``FAN_OUT`` rows a key, an eighth of the one below.
    """
    leaves = leaves.withColumn("hi", c("lo") + 1)
    built = Forest(tree, [leaves])
    most = leaves.agg(F.max("n")).first()[0] or 0
    below, width = leaves, 1
    while width < most:
        level = len(built.levels)
        # Trees that one node covers already grow no further.
        rows = (
            below.where(c("n") > width).groupBy(tree, "n", built.bucket(level).alias("_bucket"))
            .agg(
                F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),
            )
        )
        whole = F.array_join(F.transform("children", lambda x: x["digest"]), "")
        below = scratch.store(
            rows.select(tree, "n", "lo", "hi", "children", digest(whole).alias("digest")),
            "manifest-level",
        )
        built.levels.append(below)
        width *= FAN_OUT
    return built


def manifest(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    text: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Per row: ``key``, leaf, subroot, root, path, and the leaf as its present text gives it.

    Leaves of a group ascend by key; equal keys ascend by digest, so that repeated rows have their own
    places. A null key is below all others, and a null group is a tree of its own, before the others.
    Empty texts are of 0 bytes, null ones are marked otherwise. Of ``docs`` only the named columns are
    read. An empty table has no nodes and gives no rows.
    """
    spark = docs.sparkSession
    scratch, work = scratch or Scratch(spark), Scratch(spark)
    # Lower-casing by ``translate`` leaves all but A-Z as it is.
    lowered = F.translate(c(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spoilt = F.crc32(c(key).cast("string").cast("binary")) % TAMPERED == 0
    changed = leaf([lowered if x == text else c(x) for x in fields])
    # Texts are read once, here; all later steps move digests. The last column parts repeated rows.
    hashed = work.store(
        docs.select(
            c(key).alias("key"), c(group).alias("tree"), leaf([c(x) for x in fields]).alias("digest"),
            F.when(spoilt, changed).alias("changed"),
            F.monotonically_increasing_id().alias("nth"),
        ),
        "manifest-leaves",
    )
    leaves = scratch.store(
        ranked(hashed, "tree", ["key", "digest", "nth"], work).drop("nth"), "manifest-ranked"
    )
    work.clear()
    lower = forest(leaves, "tree", scratch)
    roots = lower.tops().select(
        "tree", c("level").alias("own"), c("digest").alias("subroot"), F.lit(0).alias("all"),
        "digest",
    )
    roots = work.store(roots, "manifest-roots")
    roots = work.store(ranked(roots, "all", ["tree"], work), "manifest-groups")
    upper = forest(roots, "all", work)
    end = upper.tops().select(
        "all", "level", c("digest").alias("root"), F.array().cast(PATH).alias("path")
    )
    # One row per group: its root, and the path from there.
    groups = upper.paths(end, ["root"]).select("tree", c("own"), "subroot", "root", "path")
    groups = scratch.store(groups.withColumnRenamed("own", "level"), "manifest-tops")
    work.clear()
    return lower.paths(groups, ["subroot", "root"]).select(
        c("key").alias(key), c("digest").alias("leaf"), "subroot", "root", "path",
        F.coalesce("changed", "digest").alias("present"),
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``manifest``; ``verified`` tells whether a row is as it was."""
    told = manifest(docs)
    return told.select(
        "doc_id", "leaf", "subroot", "root", proof(c("path")).alias("proof_sha256"),
        folded(c("present"), c("path")).alias("folded_root"),
    ).withColumn("verified", c("folded_root") == c("root"))
