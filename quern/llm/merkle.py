"""A Merkle manifest of a dataset, built by a butterfly exchange.

Every row is a leaf. Leaves of a group ascend by their order column and form a
tree of a given fanout: while several nodes remain, each run of ``fanout``
consecutive ones (the last run may be shorter, even one) becomes the digest of
their hexadecimal digests. What remains is the group's subroot; subroots,
ordered by group, form the tree above them in the same way, up to the root.

Leaves are dealt into blocks, aligned subtrees of ``fanout ** BLOCK_LEVELS``
leaves, so that a task builds all that lies inside a block. Above the blocks
there is no pass up and down: in each round the blocks below the same parent
swap the roots of their subtrees, each with the block at its own offset in
every sibling subtree, and all of them hash the parent. A block therefore holds
its whole upper proof when the last round ends. Where a sibling subtree has
fewer blocks, its blocks serve the missing offsets in turn, so that a block
receives ``fanout`` messages at most and none has to send to all.

Texts do not move: what is shuffled is two digests per row once, then one row
per block and round.

Cases: a null in any column is hashed as ``-``; null groups form one group, the
first one; null order values come first. Rows with equal order values are
ordered by their leaves, so repeated rows keep a place each. A single leaf is
its group's subroot, a single group's subroot is the root, and the proof of a
leaf without siblings is the digest of nothing. Other columns are ignored. An
empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common
from quern.plans.prefix import dense_rank_from_zero
from quern.plans.skew import null_safe_join, spread_join

FANOUT = 3
BLOCK_LEVELS = 6
#: Leaves that one task numbers, until there are more than the most ranges hold.
LEAVES_PER_RANGE = 1 << 14
#: One level of a proof: the hexadecimal digests before and after one's own in its run.
PATH = T.ArrayType(T.StructType([T.StructField("left", T.StringType(), False), T.StructField("right", T.StringType(), False)]), False)


def digest(*parts: Column) -> Column:
    """Hexadecimal SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*columns: Column) -> Column:
    """Digest of a row: each value with the number of its bytes before it, null as ``-``."""
    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest(*[field(c) for c in columns])


def fold(own: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, own, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level and from left to right, put together."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _parents(nodes: list[str], fanout: int) -> list[str]:
    return [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]


def _levels(nodes: list[str], alone: bool, fanout: int, levels: int) -> list[list[str]]:
    """A block's nodes from the leaves up to its one root: to the top if it is ``alone``, else just ``levels`` up."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        out.append(_parents(out[-1], fanout))
    return out


def _alone(block: int, n: int, fanout: int, levels: int) -> bool:
    """A first block that is not full is its group's only one; a full one has the same root in both cases."""
    return block == 0 and n < fanout**levels


def _block_table(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per (group, block): its members in order, and its root."""
    kinds = {f.name: f for f in rows.schema.fields}
    schema = T.StructType([kinds["_group"], T.StructField("_block", T.LongType()), T.StructField("_node", T.StringType()),
                           T.StructField("_ids", T.ArrayType(kinds["_order"].dataType)),
                           T.StructField("_leaves", T.ArrayType(T.BinaryType())), T.StructField("_seen", T.ArrayType(T.BinaryType()))])

    def run(key, table):
        table = table.sort_by("_place")
        group, block = key
        nodes = [v.hex() for v in table.column("_leaf").to_pylist()]
        root = _levels(nodes, _alone(block.as_py(), len(nodes), fanout, levels), fanout, levels)[-1][0]

        def one(name):
            values = table.column(name).combine_chunks()
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.table([pa.array([group.as_py()], table.schema.field("_group").type), pa.array([block.as_py()], pa.int64()), pa.array([root]),
                         one("_order"), one("_leaf"), one("_seen")], ["_group", "_block", "_node", "_ids", "_leaves", "_seen"])

    blocks = rows.withColumn("_block", F.expr(f"`_place` div {fanout**levels}"))
    return blocks.groupBy("_group", "_block").applyInArrow(run, schema)


def _with_local_paths(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Replace ``_leaves`` by ``_paths``: of each member its steps inside the block."""
    schema = T.StructType([*blocks.schema.fields, T.StructField("_paths", T.ArrayType(PATH, False))])
    at = blocks.columns.index("_leaves"), blocks.columns.index("_block")

    def run(batch: pa.RecordBatch):
        for i in range(batch.num_rows):  # a block at a time: at most fanout ** levels paths in memory
            nodes = [v.hex() for v in batch.column(at[0])[i].as_py()]
            tree = _levels(nodes, _alone(batch.column(at[1])[i].as_py(), len(nodes), fanout, levels), fanout, levels)[:-1]
            left, right = [], []
            for place in range(len(nodes)):
                for level in tree:
                    first = place - place % fanout
                    left.append("".join(level[first:place]))
                    right.append("".join(level[place + 1:first + fanout]))
                    place //= fanout
            steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())],
                                               fields=[pa.field("left", pa.string(), False), pa.field("right", pa.string(), False)])
            per = len(tree)
            paths = pa.ListArray.from_arrays(pa.array(range(0, per * len(nodes) + 1, per) if per else [0] * (len(nodes) + 1), pa.int32()), steps)
            made = pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), paths)
            yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, made], [*batch.schema.names, "_paths"])

    return common.map_arrow(blocks, run, schema)


def _partners(place: str, width: int, total: str, fanout: int) -> Column:
    """Places that take this place's node in a round in which subtrees have ``width`` places: one's own, and those at
    its offset in every sibling subtree, or at offsets that only it can serve."""
    tree, offset = f"({place} div {width})", f"({place} % {width})"
    first = f"({tree} - {tree} % {fanout})"
    last = f"(least({first} + {fanout}, ({total} + {width - 1}) div {width}) - 1)"

    def size(of):
        return f"least({width}L, {total} - {of} * {width})"

    held = f"sequence({offset}, greatest({size('s')} - 1, {offset}), {size(tree)})"
    return F.expr(f"flatten(transform(sequence({first}, {last}), s -> CASE WHEN {offset} < {size('s')} "
                  f"THEN transform({held}, o -> s * {width} + o) ELSE CAST(array() AS array<bigint>) END))")


def _swapped(messages: DataFrame, keys: list[str], tree: str, open_level: str) -> DataFrame:
    """State after a round: (keys, _node, _own) from messages (keys, _from, _node, _own); ``_own`` is null in those of others.

    A place hashes its parent if ``open_level``; ``tree`` is its own subtree among those that were swapped.
    """
    run = messages.groupBy(*keys).agg(F.expr("sort_array(collect_list(struct(_from, _node))) AS _run"), F.expr("first(_own, true) AS _own"))
    parts = {name: f"array_join(transform(filter(_run, m -> m._from {sign} {tree}), m -> m._node), '')"
             for name, sign in (("left", "<"), ("mine", "="), ("right", ">"))}
    parent = f"sha2(CAST(concat({parts['left']}, {parts['mine']}, {parts['right']}) AS BINARY), 256)"
    step = f"array(named_struct('left', {parts['left']}, 'right', {parts['right']}))"
    grown = f"named_struct('path', concat(_own.path, {step}), 'group', _own.group, 'subroot', _own.subroot)"
    return run.selectExpr(*keys, f"CASE WHEN {open_level} THEN {parent} ELSE {parts['mine']} END AS _node",
                          f"CASE WHEN {open_level} THEN {grown} ELSE _own END AS _own")


def _rounds(total: int, fanout: int) -> int:
    rounds = 0
    while fanout**rounds < total:
        rounds += 1
    return rounds


def _upper(blocks: DataFrame, fanout: int) -> DataFrame:
    """(group, block, path above the block, subroot, root), by the exchange between blocks."""
    counts = blocks.groupBy("_group").agg((F.max("_block") + 1).alias("_blocks"))
    sizes = common.kept(dense_rank_from_zero(counts, "_index", ["_group"]), "groups")
    most, groups = sizes.agg(F.max("_blocks"), F.count(F.lit(1))).first()
    own = F.struct(F.array().cast(PATH).alias("path"), F.col("_group").alias("group"), F.lit(None).cast("string").alias("subroot"))
    state = spread_join(blocks.select("_group", "_block", "_node"), sizes, ["_group"], ["_block"]).select(
        "_index", "_blocks", "_block", "_node", own.alias("_own"))
    keys = ["_index", "_blocks", "_block"]
    for r in range(_rounds(most or 0, fanout)):
        width = fanout**r
        sent = state.withColumn("_to", F.explode(_partners("_block", width, "_blocks", fanout)))
        messages = sent.selectExpr("_index", "_blocks", "_to AS _block", f"_block div {width} AS _from", "_node",
                                   "CASE WHEN _to = _block THEN _own END AS _own")
        state = _swapped(messages, keys, f"(_block div {width})", f"_blocks > {width}")
    state = state.selectExpr(*keys, "_node", "named_struct('path', _own.path, 'group', _own.group, 'subroot', _node) AS _own")
    targets = sizes.selectExpr("_index AS _at", "_blocks AS _there")
    for r in range(_rounds(groups, fanout)):
        width = fanout**r
        sent = state.withColumn("_at", F.explode(_partners("_index", width, f"{groups}L", fanout))).join(targets, "_at")
        # A group of fewer blocks serves those of a larger one in turn.
        sent = sent.withColumn("_to", F.expr("explode(CASE WHEN _block < _there THEN sequence(_block, greatest(_there - 1, _block), _blocks) END)"))
        messages = sent.selectExpr("_at AS _index", "_there AS _blocks", "_to AS _block", f"_index div {width} AS _from", "_node",
                                   "CASE WHEN _at = _index AND _to = _block THEN _own END AS _own")
        state = _swapped(messages, keys, f"(_index div {width})", f"{groups} > {width}")
    return state.select(F.col("_own.group").alias("_group"), "_block", F.col("_own.path").alias("_above"),
                        F.col("_own.subroot").alias("_subroot"), F.col("_node").alias("_root"))


def manifest(df: DataFrame, own: Column, group: str, order: str, seen: Column | None = None,
             fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per row: ``order``, ``leaf``, ``seen``, ``path``, ``subroot`` and ``root``.

    ``own`` is the hexadecimal digest of a row (``leaf``), ``seen`` that of the
    row as it is found now, if the two may differ; ``path`` leads from either
    to a root (``fold``).
    """
    rows = df.select(F.col(group).alias("_group"), F.col(order).alias("_order"), F.unhex(own).alias("_leaf"),
                     F.unhex(own if seen is None else seen).alias("_seen"))
    leaves = common.kept(rows, "leaves")  # the texts are read once
    placed = dense_rank_from_zero(leaves, "_place", ["_order", "_leaf"], ["_group"], rows_per_range=LEAVES_PER_RANGE)
    blocks = common.kept(_block_table(placed, fanout, levels), "blocks")
    common.drop_kept(leaves)
    joined = null_safe_join(blocks.drop("_node"), _upper(blocks, fanout), ["_group", "_block"])
    members = F.inline(F.arrays_zip("_ids", "_leaves", "_seen", "_paths"))
    rows = _with_local_paths(joined, fanout, levels).select(members, "_above", "_subroot", "_root")
    return rows.select(F.col("_ids").alias(order), F.lower(F.hex("_leaves")).alias("leaf"), F.lower(F.hex("_seen")).alias("seen"),
                       F.concat("_paths", "_above").alias("path"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"))


def tampered_proofs(df: DataFrame, doc_id: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars",
                    text: str = "text") -> DataFrame:
    """Proofs of all documents, checked against texts of which half have lost their line feeds."""
    docs = common.narrow(df, doc_id=doc_id, source=source, lang=lang, n_chars=n_chars, text=text)
    fields = [F.col(f"_{c}") for c in ("doc_id", "source", "lang", "n_chars")]
    touched = F.crc32(F.col("_doc_id").cast("string").cast("binary")) % 2 == 0
    own = leaf(*fields, F.col("_text"))
    seen = F.when(touched & F.contains("_text", F.lit("\n")), leaf(*fields, F.replace("_text", F.lit("\n"), F.lit("")))).otherwise(own)
    rows = manifest(docs, own, "_source", "_doc_id", seen)
    rows = rows.withColumn("folded_root", fold(F.col("seen"), F.col("path")))
    return rows.select(F.col("_doc_id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
