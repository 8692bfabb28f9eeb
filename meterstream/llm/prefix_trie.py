"""Prefix trie of conversations, with subtree totals by bands of depths.

A node is a distinct sequence of the first d turns.  It is named by its depth
and 128 bits: the exclusive or, over its turns, of two 64-bit hashes of place,
role and text, so that a long conversation's nodes are numbered in parts, too.

Totals of subtrees: depths are cut into bands of fixed height.  A node adds its
values to its ancestors within its band only.  Band tops form a trie of their
own, lower by the height of a band; it is totalled in the same way, and the
completed total of a top is added to the parent above it before that band's
nodes are totalled.  So there are as many rounds as the longest conversation
has digits to the base of the height, and a node is repeated at most once for
each depth of a band.

A conversation, node or parent that holds a third of all rows is dealt to many
tasks: conversations are cut where a task ends, parents of very many children
(fewer than a thousand can be) are broadcast, ends of one node are written out
in pieces before they are hashed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, staged

#: Depths of a band, and bands numbered in one part of a conversation.
BAND, PART = 32, 512
NODE = ["depth", "k1", "k2"]
NO_MEMBERS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of an empty string


def _places(batches):
    """Of rows sorted by conversation: the place of each within its conversation and this task."""
    from pyspark import TaskContext
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        rows = np.arange(len(conv))
        place = rows - np.repeat(edges, np.diff(np.append(edges, len(conv))))
        if last == conv[0]:
            place[conv == last] += seen
        last, seen = int(conv[-1]), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("digest"), batch.column("bytes"),
             pa.array(np.full(len(conv), part, np.int32)), pa.array(place)], names=["conv", "digest", "bytes", "part", "at"])


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``conv, place, digest, bytes`` of each turn, ``conv, turns`` of each conversation); places count from 0.

    Turns are ordered by ``turn`` (null first), equal ones by the digest of role
    and text.  ``bytes`` is the length of the text in UTF-8; null roles and
    texts are empty.  Rows without a conversation (ids that are no whole
    numbers, too) belong to none and are left out.
    """
    r, t = F.coalesce(quoted(role), F.lit("")), F.coalesce(quoted(text), F.lit(""))
    rows = conversations.select(
        quoted(conv_id).try_cast("long").alias("conv"), quoted(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t))).alias("digest"),
        F.octet_length(t).cast("long").alias("bytes")).filter("conv IS NOT NULL")
    order = ["conv", "turn", "digest"]
    turns = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_places, "conv long, digest binary, bytes long, part int, at long"), "turns")
    parts = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Only a task's first conversation can have begun in another one: a row for each task at most.
    begun = parts.select("conv", "part", before.alias("before")).filter("before > 0")
    placed = turns.join(F.broadcast(begun), ["conv", "part"], "left").select(
        "conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "bytes", "part")
    return placed, parts.groupBy("conv").agg(F.sum("n").alias("turns"))


def shared_starts(turns: DataFrame, lengths: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first of their group: ``conv, place, digest, bytes`` and ``conv, turns``.

    Conversation c gets the first h turns of conversation c - c % group (none
    where that is absent), then its own after its first h; h = CRC-32 of c in
    decimal, modulo ``most``.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = F.col("conv") - F.col("conv") % group
    about = lengths.select("conv", "turns", h.alias("h"), base.alias("base"))
    about = (about.join(lengths.select(F.col("conv").alias("base"), F.col("turns").alias("there")), "base", "left")
             .select("conv", "base", "turns", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")))
    # By conversation and task, so that a very long conversation isn't one group.
    parts = turns.select("conv", "part").distinct().join(about, "conv")
    own = (turns.join(parts, ["conv", "part"]).filter("place >= h")
           .select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "bytes"))
    first = (turns.filter((F.col("place") < most - 1) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
             .join(about.filter("h > 0").select("conv", "base", "h"), "base").filter("place < h")
             .select("conv", "place", "digest", "bytes"))
    return own.union(first), about.select("conv", (F.col("taken") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns"))


def _segments(turns: DataFrame) -> DataFrame:
    """``conv, band, path``: the nodes of a conversation within a band, before them the node that the band hangs on."""
    place = F.col("place")
    rows = turns.select(
        "conv", F.floor(place / (BAND * PART)).alias("part"), F.floor(place / BAND).alias("band"),
        F.struct((place + 1).alias("depth"), F.xxhash64("place", "digest").alias("k1"),
                 F.xxhash64("digest", "place", F.lit(1)).alias("k2"), "bytes").alias("turn"))
    bands = (rows.repartition("conv", "part").groupBy("conv", "part", "band")
             .agg(F.array_sort(F.collect_list("turn")).alias("turns"), F.bit_xor("turn.k1").alias("x1"), F.bit_xor("turn.k2").alias("x2")))
    before = lambda c, *keys, by: F.coalesce(F.bit_xor(c).over(
        Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    parts = rows.groupBy("conv", "part").agg(F.bit_xor("turn.k1").alias("x1"), F.bit_xor("turn.k2").alias("x2"))
    parts = parts.select("conv", "part", *[before(f"x{n}", "conv", by="part").alias(f"p{n}") for n in (1, 2)])
    placed = bands.select("conv", "part", "band", "turns", *[before(f"x{n}", "conv", "part", by="band").alias(f"b{n}") for n in (1, 2)])
    joined = placed.join(parts, ["conv", "part"])
    top = F.struct((F.col("band") * BAND).alias("depth"), F.col("b1").bitwiseXOR(F.col("p1")).alias("k1"),
                   F.col("b2").bitwiseXOR(F.col("p2")).alias("k2"), F.lit(0).cast("long").alias("bytes"))

    def grown(path: Column, turn: Column) -> Column:
        up = F.element_at(path, -1)
        return F.concat(path, F.array(F.struct(turn["depth"].alias("depth"), up["k1"].bitwiseXOR(turn["k1"]).alias("k1"),
                                               up["k2"].bitwiseXOR(turn["k2"]).alias("k2"), turn["bytes"].alias("bytes"))))

    return joined.select("conv", "band", F.aggregate("turns", F.array(top), grown).alias("path"))


def _bare(node: Column) -> Column:
    return F.struct(*[node[c].alias(c) for c in NODE])


def _nodes(segments: DataFrame) -> DataFrame:
    """``node, up, line, bytes, n_convs, conv_id``: ``up`` is the parent, ``line`` the nodes of the band down to this one."""
    # Equal segments, as those of copies, are counted before they are taken apart.
    last = F.element_at("path", -1)
    equal = (segments.groupBy(*[last[c].alias(c) for c in NODE])
             .agg(F.any_value("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")))
    each = equal.select("path", "n", "conv", F.explode(F.sequence(F.lit(2), F.size("path"))).alias("i"))
    at = F.element_at("path", F.col("i"))
    line = F.transform(F.slice("path", F.lit(2), F.col("i") - 1), _bare)
    return (each.select(_bare(at).alias("node"), _bare(F.element_at("path", F.col("i") - 1)).alias("up"), line.alias("line"),
                        at["bytes"].alias("bytes"), "n", "conv")
            .groupBy("node").agg(F.any_value("up").alias("up"), F.any_value("line").alias("line"), F.any_value("bytes").alias("bytes"),
                                 F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id")))


def _tops(items: DataFrame) -> DataFrame:
    """``conv, band, path`` one level up: of (conv, i, node) the items of each band, before them the last of the band above."""
    band = F.floor(F.col("i") / BAND)
    both = F.when(F.col("i") % BAND == BAND - 1, F.array(band, band + 1)).otherwise(F.array(band))
    return (items.select("conv", F.struct("i", "node").alias("item"), F.explode(both).alias("band"))
            .groupBy("conv", "band").agg(F.array_sort(F.collect_list("item")).alias("path"))
            .filter(F.element_at("path", -1)["i"] >= F.col("band") * BAND))


def _upper_nodes(tops: DataFrame) -> DataFrame:
    """``node, up, line`` of a level of band tops."""
    own = F.col("path")[F.col("i") - 1]
    before = F.when(F.col("band") > 0, 1).otherwise(0)  # the item of the band above
    each = tops.select("path", before.alias("before"), F.explode(F.sequence(before + 1, F.size("path"))).alias("i"))
    up = F.when(F.col("i") > 1, F.element_at("path", F.greatest(F.col("i") - 1, F.lit(1)))["node"])
    line = F.transform(F.slice("path", F.col("before") + 1, F.col("i") - F.col("before")), lambda x: x["node"])
    return (each.select(own["node"].alias("node"), up.alias("up"), line.alias("line"))
            .groupBy("node").agg(F.any_value("up").alias("up"), F.any_value("line").alias("line")))


VALUES = ("leaves", "saved")


def _totals(nodes: DataFrame) -> DataFrame:
    """Sums over each node and those below it in its band."""
    return (nodes.select(F.explode("line").alias("node"), *VALUES).groupBy("node")
            .agg(*[F.sum(v).alias(v) for v in VALUES]))


def subtree_totals(nodes: DataFrame, segments: DataFrame, longest: int) -> DataFrame:
    """``node, leaves, saved`` summed over each node's subtree, for all nodes but the root."""
    levels, size = [nodes.select("node", "up", "line", *VALUES)], BAND
    items = segments.filter((F.col("band") > 0) | (F.size("path") > BAND)).select(
        "conv", F.col("band").alias("i"), _bare(F.element_at("path", 2)).alias("node"))
    while size < longest:
        tops = staged(_tops(items), "tops")
        own = (levels[-1].groupBy(F.col("line")[0].alias("node")).agg(*[F.sum(v).alias(v) for v in VALUES]))
        levels.append(staged(_upper_nodes(tops).join(own, "node"), "level"))
        first = F.when(F.col("band") > 0, 2).otherwise(1)
        items = (tops.filter((F.col("band") > 0) | (F.size("path") >= BAND))
                 .select("conv", F.col("band").alias("i"), F.element_at("path", first)["node"].alias("node")))
        size *= BAND
    total = _totals(levels[-1])
    for lower in reversed(levels[:-1]):
        hung = (staged(total, "total").join(lower.select("node", "up"), "node").filter("up.depth > 0").groupBy(F.col("up").alias("node"))
                .agg(*[F.sum(v).alias(f"more_{v}") for v in VALUES]))
        total = _totals(lower.join(hung, "node", "left").select(
            "line", *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in VALUES]))
    return total


ENDS = "depth long, k1 long, k2 long, first long, ids binary"


def _written(batches):
    """Of (node, conversation) in order: the ids of a node as text, in pieces."""
    names = [f.split()[0] for f in ENDS.split(", ")]
    node, first, ids, out = None, None, [], []
    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv"))):
            if key != node or len(ids) == 50_000:
                if ids:
                    out.append((*node, first, ",".join(map(str, ids)).encode()))
                node, first, ids = key, conv, []
            ids.append(conv)
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
            out = []
    if ids:
        out.append((*node, first, ",".join(map(str, ids)).encode()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)


def _hashed(batches):
    """Of a node's pieces in order: their SHA-256; a piece at a time is held."""
    from hashlib import sha256
    names = [*NODE, "ends"]
    node, digest, out = None, None, []
    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, sha256(ids)
            else:
                digest.update(b"," + ids)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
            out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], names=names)


def _ends(segments: DataFrame, lengths: DataFrame) -> DataFrame:
    """``node, ends_sha256``: digest of the conversations that end at each node."""
    last = segments.groupBy("conv").agg(F.max(_bare(F.element_at("path", -1))).alias("node"))
    ends = lengths.join(last, "conv", "left").select(
        *[F.coalesce(F.col("node")[c], F.lit(0).cast("long")).alias(c) for c in NODE], "conv")
    order = [*NODE, "conv"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_written, ENDS)
    return (pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_hashed, "depth long, k1 long, k2 long, ends string")
            .select(F.struct(*NODE).alias("node"), F.col("ends").alias("ends_sha256")))


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv, place, digest, bytes) of the conversations in ``lengths`` (conv, turns).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens``
    (over the node's subtree), ``ends_sha256``.  Conversations without turns are
    members of the root only.  No conversation at all gives no rows.
    """
    segments = staged(_segments(turns), "segments")
    lengths = staged(lengths, "lengths")
    found = staged(_nodes(segments), "nodes")
    root = lengths.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("turns").alias("longest")).first()
    children = staged(found.groupBy("up").agg(F.count(F.lit(1)).alias("n_children")), "children")
    nodes = staged(found.join(children.withColumnRenamed("up", "node"), "node", "left").select(
        "node", "up", "line", "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "valued")
    every = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    totals = subtree_totals(nodes, segments, root.longest or 0)

    # The parent's smallest member: of parents with over a thousandth of all nodes there are fewer than a thousand.
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") * 1000 > every.n).drop("n_children"))
    below = nodes.filter("node.depth > 1").select("node", "up")
    named = (below.join(hot, "up").union(below.join(hot, "up", "left_anti").join(parents.drop("n_children"), "up"))
             .select("node", "parent_conv_id"))
    ends = _ends(segments, lengths)
    top = nodes.sparkSession.createDataFrame(
        [((0, 0, 0), root.conv, None, root.n, None, every.leaves or 1, every.saved or 0)] if root.n else [],
        "node struct<depth:long,k1:long,k2:long>, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long")
    top = (top.join(children.filter("up.depth = 0").select(F.col("n_children").alias("n")), F.lit(True), "left")  # one row
           .withColumn("n_children", F.coalesce("n", F.lit(0))).drop("n"))
    rest = nodes.join(totals.withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"}), "node").join(named, "node", "left").select(
        "node", "conv_id", F.when(F.col("node.depth") == 1, F.lit(root.conv)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens")
    return top.union(rest).join(ends, "node", "left").select(
        "conv_id", "node.depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, group: int = 5, most: int = 9, **columns) -> DataFrame:
    """The trie (``trie``) of conversations rebuilt by ``shared_starts`` from a table of turns (``numbered``).

    Repeated rows are turns of their own.  Columns other than the four named
    aren't read.
    """
    turns, lengths = numbered(conversations, **columns)
    return trie(*shared_starts(turns, lengths, group, most))


def oracle() -> str:
    """The same over prefixes written out; ancestors are found by conversation."""
    crc = """list_reduce(list_concat([4294967295], list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT)),
             lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                                      lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))"""
    return f"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, t, md5(strlen(role)::VARCHAR || ':' || role || t) AS m, turn FROM o),
p AS MATERIALIZED (SELECT c, strlen(t) AS bytes, m, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) - 1 AS p FROM n),
ids AS (SELECT c, c::VARCHAR AS s, c - c % 5 AS base FROM (SELECT DISTINCT c FROM p)),
h AS MATERIALIZED (SELECT c, base, xor({crc}, 4294967295) % 9 AS h FROM ids),
r AS (SELECT h.c, 0 AS src, p, bytes, m FROM h JOIN p ON p.c = h.base AND p.p < h.h
      UNION ALL SELECT h.c, 1, p, bytes, m FROM h JOIN p ON p.c = h.c AND p.p >= h.h),
q AS (SELECT c, bytes, m, row_number() OVER (PARTITION BY c ORDER BY src, p) AS d FROM r),
k AS MATERIALIZED (
  SELECT c, 0 AS d, '' AS k, NULL AS up, 0 AS bytes FROM h
  UNION ALL SELECT c, d, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY d), '') AS up, bytes
  FROM (SELECT c, d, md5(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS k, bytes FROM q)),
nodes AS MATERIALIZED (
  SELECT k, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved
  FROM k GROUP BY k),
kids AS MATERIALIZED (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
sub AS (SELECT a AS k, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM (SELECT DISTINCT x.k AS a, y.k AS b FROM k x JOIN k y ON x.c = y.c AND x.d <= y.d) JOIN nodes ON nodes.k = b
        LEFT JOIN kids ON kids.k = b GROUP BY a),
ends AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS e FROM (SELECT c, arg_max(k, d) AS k FROM k GROUP BY c) GROUP BY k)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(e, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.k = n.up LEFT JOIN kids ON kids.k = n.k JOIN sub ON sub.k = n.k LEFT JOIN ends ON ends.k = n.k"""
