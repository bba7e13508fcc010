"""Merkle manifest of a dataset, by sibling-shift self-joins.

Every row is a leaf: H (lowercase hex sha256) of its fields, each ``-`` if
null, else its UTF-8 byte count, ``:`` and its value. The leaves of a group
(a language) ascend by id. A level's nodes are joined with themselves on the
computed index of each sibling -- index XOR 1 in a binary tree, the other
slots of the run of ``arity`` nodes otherwise -- and the rows in slot zero
then emit the parent, H of the run's digests as hex text; a last, shorter run
is hashed as it is, even one node. The one node that is left is the group's
subroot (a lone leaf itself); the subroots, in group order, form a tree of the
same kind, whose last node is the root.

Proofs come down the levels: a node's proof is its siblings and then its
parent's proof, one join for each level, whose rows shrink by ``arity``. So a
dataset of n rows costs joins of about 2n narrow rows each way; the texts are
read once, to make the leaves, and never shuffled. Join keys (group, index)
are unique, so a hot group is spread like any other. Indices come from one
range sort of the narrow rows: a row's place in its partition plus the counts
of the partitions before it.

Nulls: see above; a null group sorts first and has its own subroot, rows
without id come first in their group. Ties: equal ids are ordered by leaf;
repeated rows are leaves of their own, with their own proofs. Empty tables
have the root H of nothing and no proofs. Columns whose names start with
``_m_`` are for the operator's own use and may not be given.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: the levels below are cut from the plan after so many joins
CUT = 6


def digest(text: Column) -> Column:
    """H as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def as_hex(digests: Column) -> Column:
    """Digests (array of binary) as hex text, joined."""
    return F.array_join(F.transform(digests, lambda x: F.lower(F.hex(x))), "")


def leaf_text(values: list[Column]) -> Column:
    """What a leaf hashes: its values with their byte counts."""
    shown = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.concat(*[F.coalesce(s, F.lit("-")) for s in shown])


def numbered(rows: DataFrame, group: Column, order: list[Column], name: str) -> DataFrame:
    """``rows`` (stored) with _m_g (ascending with ``group``), _m_i (its place in the
    group by ``order``, from 0) and _m_m (rows of the group)."""
    keyed = rows.withColumn("_m_key", group)
    placed = stored(
        keyed.repartitionByRange(F.col("_m_key").asc_nulls_first(), *order)
        .sortWithinPartitions(F.col("_m_key").asc_nulls_first(), *order)
        .withColumn("_m_at", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_m_at", 33)
    runs = placed.groupBy(part.alias("_m_p"), "_m_key").agg(F.min("_m_at").alias("_m_first"), F.count(F.lit(1)).alias("_m_n"))
    same = Window.partitionBy("_m_key")
    before = F.coalesce(F.sum("_m_n").over(same.orderBy("_m_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("_m_p", F.col("_m_key").alias("_m_k"), "_m_first", before.alias("_m_before"), F.min("_m_first").over(same).alias("_m_g"), F.sum("_m_n").over(same).alias("_m_m"))
    whole = placed.join(runs, (part == F.col("_m_p")) & F.col("_m_key").eqNullSafe(F.col("_m_k")))
    i = F.col("_m_before") + F.col("_m_at") - F.col("_m_first")
    return whole.withColumn("_m_i", i).drop("_m_p", "_m_k", "_m_key", "_m_first", "_m_before", "_m_at")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with _m_s (slot in the run) and _m_sibs (digests of the run's
    other nodes, left to right): a self-join for each sibling index."""
    slot = F.col("_m_i") % arity
    joined = nodes.withColumn("_m_s", slot.cast("int"))
    found = []
    for step in range(1, arity):
        sibling = F.col("_m_i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("_m_i") - slot + (slot + step) % arity
        other = nodes.select(F.col("_m_g").alias("_m_og"), F.col("_m_i").alias("_m_oi"), F.col("_m_h").alias(f"_m_o{step}"))
        joined = joined.join(other, (F.col("_m_g") == F.col("_m_og")) & (sibling == F.col("_m_oi")), "left").drop("_m_og", "_m_oi")
        found.append(F.struct(((F.col("_m_s") + step) % arity).alias("s"), F.col(f"_m_o{step}").alias("h")))
    run = F.filter(F.array_sort(F.array(*found)), lambda x: x["h"].isNotNull())
    return joined.withColumn("_m_sibs", F.transform(run, lambda x: x["h"])).drop(*[f"_m_o{step}" for step in range(1, arity)])


def levels(nodes: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """The levels of the groups' trees, from ``nodes`` up, each with its
    siblings and stored; the last has one node for the largest groups. A
    group that is down to one node goes no further."""
    out: list[DataFrame] = []
    most = nodes.agg(F.max("_m_m")).first()[0] or 0
    while True:
        out.append(stored(with_siblings(nodes, arity), f"{name}-{len(out)}", "zstd"))
        if most <= 1:
            return out
        most = -(-most // arity)
        parents = out[-1].where("_m_m > 1 AND _m_s = 0")
        nodes = parents.select(
            "_m_g",
            F.ceil(F.col("_m_m") / arity).cast("long").alias("_m_m"),
            (F.col("_m_i") / arity).cast("long").alias("_m_i"),
            digest(F.concat(F.lower(F.hex("_m_h")), as_hex(F.col("_m_sibs")))).alias("_m_h"),
        )


def down(tree: list[DataFrame], tops: DataFrame, arity: int, name: str) -> DataFrame:
    """The first level of ``tree`` with _m_path, the (slot, siblings) of each
    level up to the root, and the other columns of ``tops`` (_m_g, _m_path of
    each group's last node, ...)."""
    carried = [c for c in tops.columns if c not in ("_m_g", "_m_path")]
    above: DataFrame | None = None
    for k in range(len(tree) - 1, -1, -1):
        level = tree[k] if k == 0 else tree[k].select("_m_g", "_m_m", "_m_i", "_m_s", "_m_sibs")
        ends = level.where("_m_m <= 1").join(tops, "_m_g")
        if above is not None:
            up = above.select(F.col("_m_g").alias("_m_ug"), F.col("_m_i").alias("_m_ui"), F.col("_m_path").alias("_m_up"), *carried)
            inner = level.where("_m_m > 1").join(up, (F.col("_m_g") == F.col("_m_ug")) & ((F.col("_m_i") / arity).cast("long") == F.col("_m_ui")))
            own = F.array(F.struct(F.col("_m_s").alias("slot"), F.col("_m_sibs").alias("siblings")))
            ends = ends.unionByName(inner.withColumn("_m_path", F.concat(own, F.col("_m_up"))).drop("_m_ug", "_m_ui", "_m_up"))
        above = ends
        if k and (len(tree) - k) % CUT == 0:
            above = stored(above, f"{name}-{k}", "zstd")
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its proof lead to."""

    def up(held: Column, at: Column) -> Column:
        left, right = F.slice(at["siblings"], F.lit(1), at["slot"]), F.slice(at["siblings"], at["slot"] + 1, F.greatest(F.size(at["siblings"]) - at["slot"], F.lit(0)))
        return F.sha2(F.concat(as_hex(left), held, as_hex(right)), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """H of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: as_hex(at["siblings"])), ""), 256)


def manifest(rows: DataFrame, leaf: Column, group: str, order: str, arity: int = 2, carry: list[Column] | None = None) -> tuple[DataFrame, str]:
    """(rows, root): for each row ``order``, the columns ``carry``, leaf,
    subroot (hex), path (its proof) and root."""
    if arity < 2:
        raise ValueError("arity must be at least 2")
    narrow = rows.select(F.col(group).alias("_m_group"), F.col(order).alias("_m_order"), digest(leaf).alias("_m_h"), *(carry or []))
    leaves = numbered(narrow, F.col("_m_group"), [F.col("_m_order").asc_nulls_first(), F.col("_m_h")], "leaves").drop("_m_group")
    tree = levels(leaves, arity, "level")
    ends = [level.where("_m_m = 1").select(F.col("_m_g").alias("_m_sub"), "_m_h") for level in tree]
    subroots = ends[0]
    for end in ends[1:]:
        subroots = subroots.unionByName(end)
    top = levels(numbered(subroots, F.lit(0), [F.col("_m_sub")], "subroots"), arity, "top")
    last = top[-1].where("_m_m = 1").select(F.lower(F.hex("_m_h"))).first()
    root = last[0] if last else hashlib.sha256(b"").hexdigest()
    nothing = F.array().cast("array<struct<slot:int,siblings:array<binary>>>")
    over = top[-1].where("_m_m = 1").select("_m_g", nothing.alias("_m_path"))
    tops = down(top, over, arity, "top-proofs").select(F.col("_m_sub").alias("_m_g"), "_m_path", F.lower(F.hex("_m_h")).alias("subroot"))
    proven = down(tree, stored(tops, "tops", "zstd"), arity, "proofs")
    own = [c for c in proven.columns if not c.startswith("_m_") and c != "subroot"]
    made = proven.select(F.col("_m_order").alias(order), *own, F.lower(F.hex("_m_h")).alias("leaf"), "subroot", F.col("_m_path").alias("path"), F.lit(root).alias("root"))
    return made, root


def verify_documents(docs: DataFrame, arity: int = 2) -> DataFrame:
    """A manifest of ``docs`` and a check of each row against it, where the
    rows whose id's crc32 is a multiple of 7 have had 1 added to n_chars:
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    values = {name: F.col(name) for name in FIELDS}
    tampered = leaf_text([F.col("n_chars") + 1 if name == "n_chars" else v for name, v in values.items()])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    shown = leaf_text(list(values.values()))
    given = F.sha2(F.when(hit, tampered).otherwise(shown), 256).alias("given")
    made, _ = manifest(docs.select(*FIELDS), shown, "lang", "doc_id", arity, [given])
    folded = made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("given"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
