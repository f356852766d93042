"""A Merkle manifest of a dataset, whose partitions find their proofs by butterfly exchange.

Rows become leaves.  The leaves of a group (a language) are cut, in order, into partitions of
``fanout ** block_levels``, the last one with fewer; each is hashed up to its own root in one task.
Then partitions swap roots round by round: in round r the partitions that differ in digit r of their
number alone (base ``fanout``) form a group, at most ``fanout`` of them, and each takes the roots that
the others have reached.  All hash the next ancestor, each for itself, so a partition that has come to
the root holds every sibling on its way: nothing is sent down again.  The last group of a level may
have fewer partitions than the others; its members answer for the missing ones by turns, so no more
rows are exchanged than there are partitions, twice over at most.  The roots of the groups exchange in
the same way up to the root of the dataset.

Nulls: a null field is ``-`` in its leaf, a null group is one of its own and comes first, rows without
an order value come first in their group, equal ones by their leaves; repeated rows are leaves each.
Empty and very long texts are fields like others.  An empty table has no root and gives no rows.  Only
the named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from midyear.sources.shared import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Steps from a leaf to the root of its partition: 4,096 leaves at a fanout of eight.
BLOCK_LEVELS = 4


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields written as ``bytes:value``, or ``-`` where there is none."""
    text = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def dealt_third(column: Column) -> Column:
    """Whether 3 divides the crc32 of an id as text; a null id has no text."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def _in_order(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``at``, the place of each row in its group from 0 on, and ``n``, the rows of the group.

    Rows are range-partitioned and written in order; a partition and group is one row of counts.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    placed = cut_lineage(ranged.withColumns({"part": F.spark_partition_id(), "line": F.monotonically_increasing_id()}))
    pieces = placed.groupBy(group, "part").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("m"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col(group).alias("_group"), F.col("part").alias("_part"),
        (F.coalesce(F.sum("m").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("m").over(Window.partitionBy(group)).alias("n"))
    met = placed.join(pieces, (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return met.withColumn("at", F.col("line") + F.col("shift")).drop("part", "line", "_part", "_group", "shift")


def exchange(nodes: DataFrame, group: Sequence[str], fanout: int) -> DataFrame:
    """``root`` and ``proof`` of each node ``at`` of the ``n`` in its group, from its hash ``node``.

    ``proof`` lists, level by level, the place of the own ancestor in its run (``spot``) and the hashes
    of the others there, from left to right (``others``).  A node alone in its group is the root.
    """
    none = F.array().cast("array<struct<spot:bigint,others:array<string>>>")
    state = cut_lineage(nodes.withColumns({"root": F.col("node"), "proof": none}))
    most, size = state.agg(F.max("n")).first()[0] or 0, 1
    while size < most:
        family = F.expr(f"at DIV {size * fanout}")
        members = F.least(F.lit(size), F.col("n") - F.expr(f"at DIV {size}") * size)
        alone = (F.expr(f"at DIV {size}") % fanout == 0) & (members < size)
        low = F.col("at") % size
        # the members of a last, smaller group answer for those that it lacks, by turns
        seats = F.when(alone, F.array(low)).otherwise(F.sequence(low, F.lit(size - 1).cast("long"), members))
        going = state.filter(F.col("n") > size)
        sent = going.withColumn("seat", F.explode(seats)).withColumns(
            {"family": family, "mine": F.col("seat") == low, "ancestor": F.expr(f"at DIV {size}")})
        sent = sent.withColumn("proof", F.when(F.col("mine"), F.col("proof")))
        met = F.collect_list(F.struct("ancestor", "root")).over(Window.partitionBy(*group, "family", "seat"))
        got = sent.withColumn("run", F.array_sort(met)).filter("mine")
        step = F.struct(
            (F.col("ancestor") % fanout).alias("spot"),
            F.transform(F.filter("run", lambda x: x["ancestor"] != F.col("ancestor")), lambda x: x["root"]).alias("others"))
        got = got.withColumns({
            "proof": F.concat("proof", F.array(step)),
            "root": F.sha2(F.array_join(F.transform("run", lambda x: x["root"]), "").cast("binary"), 256)})
        state = cut_lineage(got.select(*state.columns).union(state.filter(F.col("n") <= size)))
        size *= fanout
    return state


def _hash(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(leaves: list[str], fanout: int, levels: int) -> list[list[str]]:
    """The hashes of a partition, level by level from its leaves to its root."""
    out = [leaves]
    for _ in range(levels):
        out.append([_hash(out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def fold(node: str, proof: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root that a node and its siblings, level by level, lead to."""
    for spot, others in proof:
        node = _hash([*others[:spot], node, *others[spot:]])
    return node


def _levels(n: Column, fanout: int, most: int) -> Column:
    """Steps to hash ``n`` leaves to one node, ``most`` at most."""
    return sum((F.when(n > fanout**k, 1).otherwise(0) for k in range(most)), F.lit(0))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    tampered: tuple[Column, Column] | None = None,
    fanout: int = 8,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``tampered`` is a condition and the text that takes the place of ``text`` where it holds: such rows
    are folded from the leaf of the changed row and the siblings of the original one.  Runs jobs.
    """
    columns = {name: F.col(f"`{name}`") for name in fields}
    leaf = digest(list(columns.values()))
    other = F.lit(None).cast("string")
    if tampered is not None:
        other = F.when(tampered[0], digest(list((columns | {"text": tampered[1]}).values())))
    leaves = cut_lineage(docs.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{order}`").alias("key"), leaf.alias("leaf"), other.alias("other")))
    placed = _in_order(leaves, "grp", ("key", "leaf"))
    width = fanout**block_levels
    blocks = placed.withColumns({
        "block": F.expr(f"at DIV {width}"), "levels": _levels(F.col("n"), fanout, block_levels),
        "n_blocks": F.expr(f"(n + {width - 1}) DIV {width}")})

    def root_of(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame.sort_values("at")
        first = own.iloc[0]
        return pd.DataFrame({
            "grp": [first["grp"]], "at": [first["block"]], "n": [first["n_blocks"]],
            "node": [levels_of(own["leaf"].tolist(), fanout, int(first["levels"]))[-1][0]]})

    kind = leaves.schema["grp"].dataType.simpleString()
    roots = blocks.drop("key", "other").groupBy("grp", "block").applyInPandas(
        root_of, f"grp {kind}, at bigint, n bigint, node string")
    parts = exchange(roots, ["grp"], fanout)
    subroots = parts.filter("at = 0").select("grp", F.col("root").alias("node"), F.lit(0).alias("all"))
    tops = exchange(_in_order(subroots, "all", ("grp",)).drop("all").withColumn("all", F.lit(0)), ["all"], fanout)
    tops = tops.select(
        F.col("grp").alias("_grp"), F.col("root").alias("top"), F.col("proof").alias("top_proof"))
    above = parts.join(tops, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        F.struct("grp").alias("at_group"), F.col("at").alias("block"), F.col("root").alias("subroot"), "top",
        F.concat("proof", "top_proof").alias("proof"))

    def prove(own: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        own, upper = own.sort_values("at"), upper.iloc[0]
        steps = [(int(s["spot"]), list(s["others"])) for s in upper["proof"]]
        tail = "".join("".join(others) for _, others in steps).encode()
        tree = levels_of(own["leaf"].tolist(), fanout, int(own["levels"].iloc[0]))
        proofs, folded = [], []
        for i, (leaf, other) in enumerate(zip(own["leaf"], own["other"])):
            inner, at = [], i
            for nodes in tree[:-1]:
                first = at - at % fanout
                inner.append((at % fanout, nodes[first:at] + nodes[at + 1 : first + fanout]))
                at //= fanout
            text = "".join("".join(others) for _, others in inner).encode()
            proofs.append(hashlib.sha256(text + tail).hexdigest())
            folded.append(fold(other or leaf, inner + steps))
        return pd.DataFrame({
            "key": own["key"], "leaf": own["leaf"], "subroot": upper["subroot"], "root": upper["top"],
            "proof_sha256": proofs, "folded_root": folded})

    keyed = blocks.select(F.struct("grp").alias("at_group"), "block", "at", "levels", F.struct("key").alias("key"), "leaf", "other")
    key = keyed.schema["key"].dataType.simpleString()
    proved = keyed.groupBy("at_group", "block").cogroup(above.groupBy("at_group", "block")).applyInPandas(
        prove, f"key {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proved.select(
        F.col("key.key").alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)
