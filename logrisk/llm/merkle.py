"""A Merkle manifest of a dataset, with a proof of every row found by pointer jumping.

A row's leaf is a digest of its columns. The leaves of a group ascend by their id; every
``FANOUT`` consecutive nodes become one node above them, until one remains, the group's subroot.
The subroots, in the order of the groups, are the leaves of one more tree, whose root stands for
the whole dataset. A manifest holds one row per node above the leaves.

Every node holds a segment of its way up: the siblings met so far, level by level, and a pointer to
the ancestor that the segment reaches. Segments start with one level. A self-join on the pointer
appends the ancestor's segment and takes over its pointer, so the distance doubles with each
round and a tree of ``h`` levels needs ``log2(h)`` rounds. The leaves of one run share all that
lies above their run: they stay together in one row, ride with the node above them, and add their
own siblings at the end.

Rows are numbered without a window over a group: they are dealt by ranges of (group, id, leaf) and
sorted there, and only the number of rows per range and group is summed up. Equal leaves are told
apart by a number of their own, so that no range has to hold them all. An ancestor at distance d is
the key of at most ``FANOUT ** d`` rows, so where few ancestors are left (``MOST_BROADCAST``, counted) they
are broadcast, and where there are more no key has a large part of the rows.

Nulls and odd rows: a null column is written as ``-``; a null group comes first; rows without an
id come first in their group; rows with equal ids are ordered by their leaves, and repeated rows
are leaves of their own. An empty text differs from a null one. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize

FANOUT = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ancestors that are broadcast at most, a few kilobytes each; more are joined by a shuffle.
MOST_BROADCAST = 2048
#: The tree over the groups; the trees of groups are numbered from 0 on.
_TOP = -1
_SEGMENT = "array<struct<before: binary, after: binary>>"
_POSITION_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def digest(*parts: Column) -> Column:
    """The sha256 of parts as text, one after the other, in lower-case hexadecimal digits."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(columns: Sequence[Column]) -> Column:
    """The digest of a row: every column as its UTF-8 length, ``:`` and value, or ``-``."""
    texts = [column.cast("string") for column in columns]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return digest(*[F.coalesce(part, F.lit("-")) for part in sized])


def _raw(hexadecimal: Column) -> Column:
    return F.unhex(hexadecimal)


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Add ``tree`` (a number per group, in their order), ``idx`` (the row's place in it, from 0) and
    ``size`` (its rows)."""
    placed = rows.repartitionByRange(F.col(group).asc_nulls_first(), *order).sortWithinPartitions(
        F.col(group).asc_nulls_first(), *order
    )
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("place", _POSITION_BITS)
    # A row per range and group: ranges are as many as partitions, and groups rarely share one.
    stretches = placed.groupBy(group, part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        F.col(group).alias("_group"),
        F.col("part").alias("_part"),
        "first",
        F.min("first").over(whole).alias("tree"),
        F.sum("n").over(whole).alias("size"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    )
    found = placed.join(stretches, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part")))
    idx = F.col("start") + F.col("place") - F.col("first")
    return found.select(*rows.columns, "tree", idx.alias("idx"), "size")


def _runs(nodes: DataFrame, level: int, carried: Sequence[str] = ()) -> DataFrame:
    """Nodes (``tree, idx, size, digest``) to the nodes above them: ``tree, level, idx, size`` (of
    their level), ``digest``, the ``children``'s digests joined, and their ``carried`` columns."""
    above = nodes.groupBy("tree", F.expr(f"idx div {FANOUT}").alias("above")).agg(
        F.any_value("size").alias("size"),
        F.array_sort(F.collect_list(F.struct("idx", "digest", *carried))).alias("run"),
    )
    children = F.array_join(F.transform("run", lambda child: _hex(child["digest"])), "")
    columns = [
        "tree",
        F.lit(level).alias("level"),
        F.col("above").alias("idx"),
        F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"),
        _raw(digest(children)).alias("digest"),
        _raw(children).alias("children"),
    ]
    return above.select(*columns, *(["run"] if carried else []))


def _levels(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame | None, int]:
    """All levels above ``nodes`` of ``level``, the trees' last nodes (``tree, level, digest``), and the
    highest level. Each level is stored; it has an eighth of the rows of the one before."""
    stored, lasts = [], []
    while True:
        lasts.append(nodes.filter("size = 1").select("tree", F.lit(level).alias("level"), "digest"))
        rest = nodes.filter("size > 1")
        if rest.isEmpty():
            return stored, reduce(DataFrame.unionByName, lasts), level
        level += 1
        nodes = materialize(_runs(rest, level), "merkle-level")
        stored.append(nodes)


def _siblings(children: Column, place: Column) -> Column:
    """What stands before and after a child's own 32 bytes in its run, as a segment of one level."""
    before = F.substring(children, 1, 32 * place)
    after = children.substr((32 * (place + 1) + 1).cast("int"), F.lit(32 * FANOUT))
    return F.array(F.struct(before.alias("before"), after.alias("after")))


def _pointers(levels: list[DataFrame]) -> DataFrame:
    """Each child of the nodes of ``levels`` (that is, each node that has one above it): its ``tree,
    level, idx``, its pointer ``up_tree, up_level, up_idx`` and its one-level ``segment``. The
    ``subroot`` is not known yet."""
    above = reduce(DataFrame.unionByName, [level.select("tree", "level", "idx", "children") for level in levels])
    n = (F.octet_length("children") / 32).cast("int")
    children = above.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("place"))
    return children.select(
        "tree",
        (F.col("level") - 1).alias("level"),
        (F.col("idx") * FANOUT + F.col("place")).alias("idx"),
        F.col("tree").alias("up_tree"),
        F.col("level").alias("up_level"),
        F.col("idx").alias("up_idx"),
        _siblings(F.col("children"), F.col("place")).alias("segment"),
        F.lit(None).cast("binary").alias("subroot"),
    )


def _entered(ways: DataFrame, top: DataFrame) -> DataFrame:
    """Pointers of the top tree, whose lowest nodes stand under the names that they have in the
    trees of their groups: whoever passes them learns its subroot."""
    own = top.select(F.col("idx").alias("t_idx"), "below", F.col("level").alias("own_level"), "digest")
    lowest = ways.filter("level = 0").join(own, F.col("idx") == F.col("t_idx"))
    lowest = lowest.select(
        F.col("below").alias("tree"),
        F.col("own_level").alias("level"),
        F.lit(0).cast("long").alias("idx"),
        "up_tree",
        "up_level",
        "up_idx",
        "segment",
        F.col("digest").alias("subroot"),
    )
    return lowest.unionByName(ways.filter("level > 0"))


def _jumped(nodes: DataFrame, root: tuple[int, int]) -> DataFrame:
    """Double distances until every pointer reaches the root, a node of this tree and level."""
    at_root = (F.col("up_tree") == root[0]) & (F.col("up_level") == root[1])
    place = ("tree", "level", "idx")
    distance = 1
    while True:
        nodes = materialize(nodes, "merkle-segments")
        rest = nodes.filter(~at_root)
        if rest.isEmpty():
            return nodes
        # Nothing else is an ancestor at this distance.
        able = nodes.filter((F.col("level") > distance) | (F.col("tree") == _TOP)).select(
            *[F.col(name).alias(f"a_{name}") for name in place],
            *[F.col(f"up_{name}").alias(f"b_{name}") for name in place],
            F.col("segment").alias("upper"),
            F.col("subroot").alias("upper_subroot"),
        )
        if able.count() <= MOST_BROADCAST:
            able = F.broadcast(able)
        further = rest.join(able, [F.col(f"up_{name}") == F.col(f"a_{name}") for name in place]).select(
            *place,
            *[F.col(f"b_{name}").alias(f"up_{name}") for name in place],
            F.concat("segment", "upper").alias("segment"),
            F.coalesce("subroot", "upper_subroot").alias("subroot"),
        )
        nodes = nodes.filter(at_root).unionByName(further)
        distance *= 2


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof (siblings by level) give."""
    return F.aggregate(
        proof, leaf, lambda below, level: digest(_hex(level["before"]), below, _hex(level["after"]))
    )


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda p: F.concat(_hex(p["before"]), _hex(p["after"]))), ""))


def manifest(leaves: DataFrame, group: str = "lang", key: str = "doc_id", carried: Sequence[str] = ()) -> DataFrame:
    """``key, carried, leaf, subroot, root, proof`` of rows with ``group, key, leaf`` (32 bytes) and
    the ``carried`` columns.

    ``proof`` holds a struct ``before, after`` per level, the digests of the run's other nodes, joined.
    """
    kept = [key, *carried]
    rows = leaves.select(F.col(group).alias("_group_of"), *kept, F.col("leaf").alias("digest"))
    # A number for each row, stored, so that equal rows have an order too.
    rows = materialize(rows.withColumn("row_no", F.monotonically_increasing_id()), "merkle-leaves")
    order = [F.col(key).asc_nulls_first(), F.col("digest").asc(), F.col("row_no").asc()]
    first = materialize(_runs(_numbered(rows, "_group_of", order), 1, kept), "merkle-runs")
    # A leaf that is alone in its group is the group's subroot, without a node above it.
    lonely = (F.col("size") == 1) & (F.octet_length("children") == 32)
    bare = first.filter(lonely).select("tree", F.lit(0).alias("level"), F.col("children").alias("digest"))
    levels, subroots, own_height = _levels(first.filter(~lonely).drop("run"), 1)
    subroots = materialize(bare.unionByName(subroots), "merkle-subroots")
    # A tree's number follows the order of the groups.
    top = subroots.withColumnRenamed("tree", "below").withColumn("one", F.lit(0))
    top = _numbered(top, "one", [F.col("below").asc()]).withColumn("tree", F.lit(_TOP).cast("long"))
    top = materialize(top, "merkle-top")
    top_levels, last, height = _levels(top.select("tree", "idx", "size", "digest"), 0)
    root = last.first()

    nodes = [_pointers(levels)] if levels else []
    nodes += [_entered(_pointers(top_levels), top)] if top_levels else []
    if nodes:
        # Of a single group the subroot is the root.
        reached = (_TOP, height) if top_levels else (first.select("tree").first().tree, own_height)
        ways = _jumped(reduce(DataFrame.unionByName, nodes), reached)
    else:  # a single run, or nothing at all
        ways = first.limit(0).select(
            "tree", "level", "idx", F.array().cast(_SEGMENT).alias("segment"), F.col("digest").alias("subroot")
        )
    whole = F.lit(None if root is None else root.digest).cast("binary")
    runs = first.withColumn("at", F.when(lonely, 0).otherwise(1)).alias("r").join(
        ways.alias("w"), [F.col(f"r.{a}") == F.col(f"w.{b}") for a, b in (("tree", "tree"), ("idx", "idx"), ("at", "level"))], "left"
    )
    none = F.array().cast(_SEGMENT)
    found = runs.select(
        "children",
        "at",
        F.coalesce("w.segment", none).alias("segment"),
        F.coalesce("w.subroot", whole).alias("subroot"),
        F.posexplode("run").alias("place", "row"),
    )
    own = F.when(F.col("at") == 0, none).otherwise(_siblings(F.col("children"), F.col("place")))
    return found.select(
        *[F.col("row").getField(name).alias(name) for name in kept],
        F.col("row").getField("digest").alias("leaf"),
        "subroot",
        whole.alias("root"),
        F.concat(own, "segment").alias("proof"),
    )


def tampered(doc_id: Column) -> Column:
    """True for the ids whose unsigned crc32 is divisible by 3; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def verify_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, altered, folded_root`` of every document, digests as
    hexadecimal text. ``altered`` is the leaf of the tampered document, null where none is;
    ``folded_root`` is what it, or else the leaf, gives with the original proof."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    columns = {name: F.col(name) for name in LEAF_COLUMNS}
    lowered = {**columns, "text": F.translate("text", upper, upper.lower())}
    leaves = documents.select(
        "doc_id",
        "lang",
        _raw(leaf_of(list(columns.values()))).alias("leaf"),
        F.when(tampered(F.col("doc_id")), _raw(leaf_of(list(lowered.values())))).alias("altered"),
    )
    found = manifest(leaves, carried=["altered"])
    texts = ("leaf", "subroot", "root", "altered")
    found = found.withColumns({name: _hex(F.col(name)) for name in texts})
    return found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("proof")))
