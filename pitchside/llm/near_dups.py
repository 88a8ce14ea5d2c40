"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

Texts with one set of shingles form a class; everything after works on one document per class.
Every coordinate of a signature posts its document under (coordinate, value). Two documents whose
signatures agree in ``matches`` coordinates share one of the least frequent ``coordinates - matches
+ 1`` postings of each (prefix), and a document with fewer than ``matches`` shared postings has no
partner at all; so the frequent postings are skipped when candidates are sought, and only read when
the agreeing coordinates of a candidate pair are counted. Pairs that agree often enough are
confirmed on the full sets.

Groups of copies would make a pair of any two members. So at first every document meets at most one
other, the most agreeable of the first documents of its postings (its hub); what the confirmed links
join is one component. Only postings whose documents are still in several components go on: their
documents are dealt to small blocks, and a task holds two blocks that share a posting against each
other. It counts, confirms, and gives out only links that join two components, so no pairs are
written or shuffled, and no link that would change a component is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pitchside.llm.common import Scratch, bound_batches, slices, stored
from pitchside.llm.shingles import mixed, shingle_hashes, word_hashes

c = F.col

#: Bytes of text that a task hashes at once.
SLICE = 1 << 20


@dataclass(frozen=True)
class Likeness:
    """Parameters of the join."""

    #: Words of a shingle.
    width: int = 5
    #: Linked when 100 * intersection >= percent * union.
    percent: int = 85
    #: Coordinates of a signature.
    coordinates: int = 64
    #: Agreeing coordinates of a candidate. At 85 of 100 equal shingles, fewer agree once in a
    #: million pairs (binomial).
    matches: int = 40


#: Documents of a block, and shingles, on average at most.
BLOCK, BLOCK_SHINGLES = 128, 500_000
#: Shingles of two blocks that are compared at once.
COLUMNS = 2_048
#: From here on, nodes are made of the keys of sets; those below are ids of documents.
KEY_NODES = 1 << 62


# --- signatures -------------------------------------------------------------------------------


def _scales(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.arange(coordinates, dtype=np.uint64)
    return mixed(seeds * np.uint64(2) + np.uint64(1)) | np.uint64(1), mixed(
        seeds * np.uint64(2) + np.uint64(2)
    )


def signature(hashes: np.ndarray, scales: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """The postings of a set: for each coordinate, its number and least value in 64 mixed bits."""
    least = np.full(len(scales), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2_048):
        turned = np.multiply.outer(hashes[at : at + 2_048], scales)
        turned ^= turned >> np.uint64(32)
        np.minimum(least, turned.min(axis=0), out=least)
    return mixed(least ^ salts)


SIGNED = "doc_id long, n_shingles long, set_key binary, posts array<long>"


def _signed(docs: DataFrame, text: str, like: Likeness) -> DataFrame:
    """Per document: size and key of its set of shingles, and its postings."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scales, salts = _scales(like.coordinates)
        with np.errstate(over="ignore"):
            for batch in slices(batches, SLICE, "text"):
                sets = shingle_hashes(*word_hashes(batch.column("text")), like.width)
                keys = [_key(x) for x in sets]
                posts = [signature(x, scales, salts) if len(x) else x for x in sets]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in posts])])
                flat = np.concatenate([*posts, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                        "set_key": pa.array(keys, pa.binary()),
                        "posts": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    }
                )

    return docs.select(c("doc_id").cast("long").alias("doc_id"), c(text).alias("text")).mapInArrow(
        sign, SIGNED
    )


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _key_node(set_key: str) -> Column:
    """The node of a class that no id of a document can name: 56 bits of its key, above all ids."""
    return F.conv(F.hex(F.substring(set_key, 1, 7)), 16, 10).cast("long") + F.lit(KEY_NODES)


def _sets(docs: DataFrame, text: str, like: Likeness) -> DataFrame:
    """Per row, its node and its set of shingles as sorted 64-bit hashes.

    The node is the row's ``doc_id``, or made of the set where ``several`` sets go by that id.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, SLICE, "text"):
                sets = shingle_hashes(*word_hashes(batch.column("text")), like.width)
                nodes = [
                    KEY_NODES + int.from_bytes(_key(x)[:7], "big") if several else doc_id
                    for x, several, doc_id in zip(
                        sets, batch.column("several").to_pylist(), batch.column("doc_id").to_pylist()
                    )
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": pa.array(nodes, pa.int64()),
                        "hashes": pa.array([x.tobytes() for x in sets], pa.binary()),
                    }
                )

    return docs.select("doc_id", "several", c(text).alias("text")).mapInArrow(
        hashes, "node long, hashes binary"
    )


# --- candidates -------------------------------------------------------------------------------


def _prefixes(classes: DataFrame, scratch: Scratch, like: Likeness) -> DataFrame:
    """``node, post``: the postings in which each document seeks its partners.

    A posting with one document finds nobody; sorted by frequency these come first, so a document
    posts under what is left of the prefix after them.
    """
    posts = classes.select("node", F.explode("posts").alias("post"))
    shared = posts.groupBy("post").agg(F.count("*").alias("freq")).where("freq > 1")
    held = posts.join(scratch.store(shared, "postings"), "post")
    by_node = held.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("freq", "post"))).alias("held")
    )
    long_enough = by_node.where(F.size("held") >= like.matches)
    prefix = F.slice("held", 1, F.size("held") - like.matches + 1)
    return long_enough.select("node", F.explode(prefix).alias("at")).select("node", "at.post")


def _alike(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """The pairs ``a, b`` whose sizes allow the likeness and whose signatures agree often enough.

    Adds ``agree``, the number of agreeing coordinates.
    """
    side = classes.select("node", "n_shingles", "posts")
    for end in ("a", "b"):
        told = side.toDF(end, f"n_{end}", f"posts_{end}")
        pairs = pairs.join(told, end)
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (
        pairs.where(100 * small >= like.percent * large)
        .withColumn("agree", F.size(F.array_intersect("posts_a", "posts_b")))
        .where(c("agree") >= like.matches)
        .select("a", "b", "agree")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs whose full sets are alike."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= like.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(sets.select(c("node").alias("a"), c("hashes").alias("x")), "a")
        .join(sets.select(c("node").alias("b"), c("hashes").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(compare, "a long, b long")
    )


# --- components -------------------------------------------------------------------------------


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (the least node that is reachable) for the ends of ``a, b``.

    Each step takes the least label among the neighbours and then that label's own label, so that
    chains shrink by more than half a step.
    """
    ends = scratch.store(
        links.select(c("a").alias("node"), c("b").alias("other")).union(
            links.select(c("b"), c("a"))
        ).distinct(),
        "ends",
    )
    labels = scratch.store(
        ends.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
    )
    while True:
        told = labels.toDF("other", "offered")
        offers = ends.join(told, "other").groupBy("node").agg(F.min("offered").alias("offered"))
        nearer = labels.join(offers, "node").select(
            "node", F.least("component", "offered").alias("component"),
            c("component").alias("was"),
        )
        nearer = scratch.store(nearer, "nearer")
        jump = nearer.select(c("node").alias("component"), c("component").alias("beyond"))
        after = nearer.join(jump, "component", "left").select(
            "node", F.least("component", "beyond").alias("component"), "was"
        )
        after = scratch.store(after, "labels")
        labels = after.select("node", "component")
        if after.where("component <> was").isEmpty():
            return labels


# --- the join ---------------------------------------------------------------------------------


def _mixed_postings(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, post, component`` of the postings whose documents are in several components."""
    labelled = prefixes.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        labelled.groupBy("post")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("post")
    )
    return labelled.join(several, "post", "left_semi")


def _hub_pairs(posted: DataFrame) -> DataFrame:
    """Each document with the first one of each posting, across components."""
    hubs = posted.groupBy("post").agg(
        F.min(F.struct("component", "node")).alias("hub")
    )
    return (
        posted.join(hubs, "post")
        .where(c("component") != c("hub.component"))
        .select(c("node").alias("a"), c("hub.node").alias("b"))
        .distinct()
    )


def _blocks(posted: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, block``: the documents of one large posting share a block, or a few.

    A document's home is the largest posting of those that the documents of its own postings are in,
    so that a group that many postings tie together has one home.
    """
    sizes = posted.groupBy("post").agg(F.count("*").alias("n"))
    largest = F.max("at").alias("at")
    by_node = posted.join(sizes, "post").select("node", F.struct("n", "post").alias("at"))
    by_post = posted.join(by_node.groupBy("node").agg(largest), "node")
    most = posted.join(by_post.groupBy("post").agg(largest), "post").groupBy("node").agg(largest)
    homed = most.select("node", c("at.post").alias("home")).join(
        classes.select("node", "n_shingles"), "node"
    )
    counts = homed.groupBy("home").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks")
    )
    nth = F.pmod(F.xxhash64("node"), c("blocks"))
    return homed.join(counts, "home").select("node", F.xxhash64("home", nth).alias("block"))


def linked(
    one: list[tuple[int, int, np.ndarray]], two: list[tuple[int, int, np.ndarray]], like: Likeness
) -> list[tuple[int, int]]:
    """Links between two blocks (or within one, given twice) that join components.

    A block is a list of node, component and set of shingles. Signatures that agree often enough make
    candidates; their full sets are compared as rows of 0 and 1, shared shingles only.
    """
    scales, salts = _scales(like.coordinates)
    sizes = [np.array([len(x[2]) for x in block]) for block in (one, two)]
    signs = [np.array([signature(x[2], scales, salts) for x in block]) for block in (one, two)]
    parts = [np.array([x[1] for x in block]) for block in (one, two)]
    agree = np.zeros((len(one), len(two)), np.int16)
    for k in range(like.coordinates):
        agree += signs[0][:, k][:, None] == signs[1][:, k][None, :]
    large = np.maximum(sizes[0][:, None], sizes[1][None, :])
    small = np.minimum(sizes[0][:, None], sizes[1][None, :])
    open_pairs = (
        (agree >= like.matches)
        & (100 * small >= like.percent * large)
        & (parts[0][:, None] != parts[1][None, :])
    )
    rows = [np.flatnonzero(open_pairs.any(axis=1)), np.flatnonzero(open_pairs.any(axis=0))]
    if not len(rows[0]):
        return []
    flat, owner = [], []
    for block, some in zip((one, two), rows):
        flat.append(np.concatenate([block[i][2] for i in some]))
        owner.append(np.repeat(np.arange(len(some)), [len(block[i][2]) for i in some]))
    shared = np.intersect1d(flat[0], flat[1])
    both = np.zeros((len(rows[0]), len(rows[1])), np.float32)
    for at in range(0, len(shared), COLUMNS):
        known = shared[at : at + COLUMNS]
        sides = []
        for hashes, owners, some in zip(flat, owner, rows):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            there = known[place] == hashes
            side = np.zeros((len(some), len(known)), np.float32)
            side[owners[there], place[there]] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    both = both.astype(np.int64)
    union = sizes[0][rows[0]][:, None] + sizes[1][rows[1]][None, :] - both
    alike = open_pairs[np.ix_(*rows)] & (100 * both >= like.percent * union)
    # Of these, a link for each join of two components is enough.
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    out = []
    for i, j in np.argwhere(alike).tolist():
        a, b = one[rows[0][i]], two[rows[1][j]]
        x, y = root(a[1]), root(b[1])
        if x != y:
            above[max(x, y)] = min(x, y)
            out.append((a[0], b[0]))
    return out


def _rest_links(
    posted: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch, like: Likeness
) -> DataFrame:
    """Links across components between all documents that still share a posting."""
    blocks = scratch.store(_blocks(posted, classes), "blocks")
    held = posted.join(blocks, "node").select("post", "block").distinct()
    held = scratch.store(held, "held")
    pairs = (
        held.join(held.select("post", c("block").alias("other")), "post")
        .where(c("block") <= c("other"))
        .select("block", "other")
        .distinct()
        .withColumn("pair", F.xxhash64("block", "other"))
    )
    components_of = posted.select("node", "component").distinct()
    members = blocks.join(components_of, "node").join(sets, "node")
    members = scratch.store(members.select("block", "node", "component", "hashes"), "members")
    pairs = scratch.store(pairs, "block-pairs")
    first = pairs.select("pair", "block", "other", F.lit(0).alias("side"))
    second = pairs.where("block <> other").select(
        "pair", c("other").alias("block"), c("block").alias("other"), F.lit(1).alias("side")
    )
    dealt = first.unionByName(second).join(members, "block").select(
        "pair", "side", (c("block") == c("other")).alias("alone"), "node", "component", "hashes"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(sides: tuple[list, list], alone: bool) -> pa.RecordBatch:
            found = linked(sides[0], sides[0] if alone else sides[1], like)
            return pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([x[0] for x in found], pa.int64()),
                    "b": pa.array([x[1] for x in found], pa.int64()),
                }
            )

        now, sides, single = None, ([], []), False
        with np.errstate(over="ignore"):
            for batch in batches:
                for pair, side, alone, node, component, hashes in zip(
                    *(column.to_pylist() for column in batch.columns)
                ):
                    if pair != now:
                        if now is not None:
                            yield links(sides, single)
                        now, sides, single = pair, ([], []), alone
                    sides[side].append((node, component, np.frombuffer(hashes, np.uint64)))
            if now is not None:
                yield links(sides, single)

    parts = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "pair")
        .sortWithinPartitions("pair", "side")
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, *, text: str = "text", like: Likeness = Likeness()
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of other than ASCII white space, with A-Z in lower case. ``component_id`` is the
    least ``doc_id`` that links lead to, the row's own included, and ``kept`` marks the rows whose
    ``doc_id`` that is. A text without words is linked with nothing, and neither is a row without a
    ``doc_id``, which is kept under no component. Rows that repeat a ``doc_id`` count as documents of
    one name: they are kept or go together when their texts are alike, and each of their texts is
    linked with what is like it. Shingles are compared by 64 mixed bits. An empty table gives an empty
    one; other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    signed = stored(_signed(docs, text, like), "signed")
    linkable = signed.where("doc_id is not null and n_shingles > 0")
    # Ids that several sets go by; none in a sound table. They can't name a class.
    mixed = F.min(F.xxhash64("set_key")) < F.max(F.xxhash64("set_key"))
    shared = scratch.store(
        linkable.groupBy("doc_id").agg(mixed.alias("several")).where("several"), "shared"
    )
    named = linkable.groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("posts").alias("posts"),
    )
    node = F.when(c("several"), _key_node("set_key")).otherwise(c("doc_id")).alias("node")
    classes = scratch.store(
        named.join(shared, "doc_id", "left")
        .select("set_key", "doc_id", node, "n_shingles", "posts"),
        "classes",
    )
    prefixes = scratch.store(_prefixes(classes, scratch, like), "prefixes")
    seekers = scratch.store(prefixes.select("node").distinct(), "seekers")
    signs = scratch.store(
        classes.select("node", "n_shingles", "posts").join(seekers, "node", "left_semi"), "signs"
    )
    # Stored, so Spark knows the size of the ids and broadcasts them only below its threshold.
    ids = classes.join(seekers, "node", "left_semi").select("doc_id").distinct()
    ids = scratch.store(ids, "ids")
    texts = docs.select(c("doc_id").cast("long").alias("doc_id"), c(text).alias(text))
    texts = texts.join(ids, "doc_id", "left_semi").join(shared, "doc_id", "left")
    texts = texts.withColumn("several", F.coalesce("several", F.lit(False)))
    sets = scratch.store(_sets(texts, text, like).dropDuplicates(["node"]), "sets")

    nothing = spark.createDataFrame([], "node long, component long")
    posted = scratch.store(_mixed_postings(prefixes, nothing), "posted")
    alike = _alike(_hub_pairs(posted), signs, like)
    # The most agreeable hub of each document is enough.
    best = alike.groupBy("a").agg(F.max(F.struct("agree", (-c("b")).alias("less"))).alias("best"))
    hubs = scratch.store(best.select("a", (-c("best.less")).alias("b")), "hubs")
    links = scratch.store(_confirmed(hubs, sets, like), "links")
    labels = components(links, scratch)
    posted = scratch.store(_mixed_postings(prefixes, labels), "posted")
    more = scratch.store(_rest_links(posted, classes, sets, scratch, like), "more-links")
    labels = components(links.unionByName(more), scratch)
    grouped = classes.select("set_key", "doc_id", "node").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    # A component's least node is its least id, but where classes have no id for a node.
    unnamed = grouped.where(c("node") >= KEY_NODES).groupBy("component")
    least = scratch.store(unnamed.agg(F.min("doc_id").alias("least")), "least")
    grouped = grouped.join(least, "component", "left").select(
        "set_key", F.least("component", "least").alias("component")
    )
    grouped = stored(grouped, "components")
    scratch.clear()
    named = signed.select("doc_id", "n_shingles", "set_key").join(grouped, "set_key", "left")
    component = F.when(
        c("doc_id").isNotNull(), F.when(c("n_shingles") > 0, c("component")).otherwise(c("doc_id"))
    )
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        c("doc_id").eqNullSafe(component).alias("kept"),
    )
