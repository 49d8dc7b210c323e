"""A Merkle manifest of a table: roots for each source and for all, with a proof for every row.

Rows are sorted by source and id through range partitions and numbered with one small
figure for each partition. Aligned blocks of consecutive rows of a source hash their
subtree on their own. Then blocks exchange roots as a butterfly does: in every
round, groups of up to ``FANOUT`` subtrees swap their roots, lane by lane, and each
block hashes the parent itself. After the last round every block knows all that its
rows' proofs need above it, so nothing has to come down the tree again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweek.llm.columns import bound_batches, col, without
from stockweek.session import scratch_dir

FANOUT = 16

# Levels that a block hashes on its own, and the rows of a full block.
BLOCK_LEVELS = 3
BLOCK_ROWS = FANOUT**BLOCK_LEVELS

_DIGITS = 64  # of a digest in hexadecimal

_STATE = ("rank", "block", "blocks", "node", "subroot", "levels", "lane", "width")

_ADDED = "leaf string, subroot string, root string, proof string, places array<int>, runs array<int>"


def digest_of(columns: Sequence[Column]) -> Column:
    """The digest of a row: of each value its UTF-8 byte count, ``:`` and itself, or ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*(F.coalesce(p, F.lit("-")) for p in parts)), 256)


def root_from_proof(leaf: Column, proof: Column, places: Column, runs: Column) -> Column:
    """The root that a leaf and a proof lead to; null if one of them is.

    ``proof`` holds the digests of the siblings, level by level, left to right. Level i
    has ``runs[i]`` members, among which the node on the way up is number ``places[i]``.
    """
    siblings = proof.cast("binary")

    def up(state: Column, level: Column) -> Column:
        left = _DIGITS * level["place"]
        right = _DIGITS * (level["run"] - 1 - level["place"])
        node = F.concat(
            F.substr(siblings, state["at"] + 1, left),
            state["node"].cast("binary"),
            F.substr(siblings, state["at"] + 1 + left, right),
        )
        return F.struct(F.sha2(node, 256).alias("node"), (state["at"] + left + right).alias("at"))

    levels = F.transform(places, lambda p, i: F.struct(p.alias("place"), F.get(runs, i).alias("run")))
    start = F.struct(leaf.alias("node"), F.lit(0).alias("at"))
    return F.when(siblings.isNotNull(), F.aggregate(levels, start, up)["node"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, source first: the task, the number of the source in it, the row's number there."""
    task = TaskContext.get().partitionId()
    run, row, last, started = 0, 0, None, False
    for batch in batches:
        runs, rows = [], []
        for source in batch.column(0).to_pylist():
            if started and source != last:
                run, row = run + 1, 0
            started, last = True, source
            runs.append(run)
            rows.append(row)
            row += 1
        columns = [pa.array([task] * len(runs), pa.int32()), pa.array(runs, pa.int64())]
        columns += [pa.array(rows, pa.int64()), *batch.columns]
        names = ["task", "run", "row", *batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _sorted_rows(leaves: DataFrame, path: str) -> DataFrame:
    """Rows with the rank of their source and their position in it."""
    spark = leaves.sparkSession
    order = ["source", "id", "leaf", "tie"]
    kept = [c for c in leaves.columns if c not in order]
    ordered = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("source", "leaf", *kept)
    fields = "task int, run bigint, row bigint, source string, leaf string"
    schema = spark.createDataFrame([], fields).schema
    for name in kept:
        schema.add(ordered.schema[name])
    ordered.mapInArrow(_numbered, schema).write.parquet(path)
    rows = spark.read.parquet(path)

    # A partition follows on the one before, so its first source may have begun there.
    runs = rows.groupBy("task", "run").agg(F.max("source").alias("source"), F.count("*").alias("n"))
    ends = runs.groupBy("task").agg(
        F.max("run").alias("last_run"),
        F.min_by(F.struct("source"), "run").alias("first"),
        F.max_by(F.struct("source", "n"), "run").alias("last"),
    )
    starts, rank, source, held = [], -1, None, 0
    for end in sorted(ends.collect()):
        if rank < 0 or end["first"]["source"] != source:
            rank, held = rank + 1, 0
        starts.append((end["task"], rank, held))
        rank += end["last_run"]
        held = end["last"]["n"] + (held if end["last_run"] == 0 else 0)
        source = end["last"]["source"]
    table = spark.createDataFrame(starts, "task int, first_rank bigint, held bigint")
    placed = rows.join(F.broadcast(table), "task")
    position = F.col("row") + F.when(F.col("run") == 0, F.col("held")).otherwise(0)
    return placed.select(
        (F.col("first_rank") + F.col("run")).alias("rank"), position.alias("position"), "leaf", *kept
    )


def _parents(nodes: Column) -> Column:
    """The digests of runs of ``FANOUT`` consecutive nodes."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(FANOUT))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, FANOUT), ""), 256))


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each block, with its rows in order and the root of its subtree."""
    block = F.floor(F.col("position") / BLOCK_ROWS).cast("bigint").alias("block")
    members = F.struct("position", *(c for c in rows.columns if c not in ("rank", "position")))
    found = rows.select("rank", block, members.alias("member")).groupBy("rank", "block")
    found = found.agg(F.sort_array(F.collect_list("member")).alias("rows"))
    nodes = found.select("*", F.col("rows.leaf").alias("nodes"))
    for _ in range(BLOCK_LEVELS):
        goes_on = (F.size("nodes") > 1) | (F.col("block") > 0)
        up = F.when(goes_on, _parents(F.col("nodes"))).otherwise(F.col("nodes"))
        nodes = nodes.withColumn("nodes", up)
    return nodes.select("rank", "block", "rows", F.get("nodes", F.lit(0)).alias("node"))


def _swap(state: DataFrame) -> DataFrame:
    """One round: the members of every group swap their nodes, and each block hashes the parent.

    A member is a subtree that ``width`` blocks stand for, one on each of the lanes
    0 to ``width`` - 1. All lanes of a group, ``lanes`` of them, need a message
    from every member; a block of a narrower one sends to further lanes as well, so
    that every lane has one row from each member, ``FANOUT`` at most.
    """
    lane = F.sequence("lane", F.col("lanes") - 1, "width")
    own = F.col("to") == F.col("lane")
    sent = state.withColumn("to", F.explode(lane))
    sent = sent.withColumn("levels", F.when(own, F.col("levels")))
    met = Window.partitionBy("rank_key", "group", "to").orderBy("place")
    whole = met.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sent = sent.withColumn("met", F.collect_list(F.struct("node", "width", "place")).over(whole))
    nodes = F.col("met.node")
    level = F.struct(F.col("place").cast("int").alias("place"), nodes.alias("nodes"))
    widths = F.transform("met", lambda m: F.when(m["place"] < F.col("place"), m["width"]).otherwise(0))
    add = lambda a, b: a + b
    zero = F.lit(0).cast("bigint")
    changed = {
        "node": F.sha2(F.array_join(nodes, ""), 256),
        "levels": F.concat("levels", F.array(level)),
        "lane": F.col("lane") + F.aggregate(widths, zero, add),
        "width": F.aggregate(F.col("met.width"), zero, add),
    }
    found = sent.filter(own).select(
        *(c for c in state.columns if c not in changed),
        *(F.when(F.col("active"), new).otherwise(F.col(c)).alias(c) for c, new in changed.items()),
    )
    return found.select(*_STATE)


def _rounds(n: int) -> int:
    """How often n nodes are hashed together until one is left."""
    rounds = 0
    while n > 1:
        n, rounds = -(-n // FANOUT), rounds + 1
    return rounds


def _upper(blocks: DataFrame) -> DataFrame:
    """For each block: its source's root, the root of all, and the levels above its own subtree."""
    sizes = blocks.groupBy("rank").agg((F.max("block") + 1).alias("blocks"))
    most, ranks = sizes.agg(F.max("blocks"), F.count("*")).first()
    none = F.array().cast("array<struct<place:int,nodes:array<string>>>")
    state = blocks.select("rank", "block", "node").join(sizes, "rank")
    zero, text = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    state = state.select(
        "rank", "block", "blocks", "node", text.alias("subroot"), none.alias("levels"),
        zero.alias("lane"), (zero + 1).alias("width"),
    )
    for r in range(_rounds(most or 0)):
        span = F.lit(FANOUT**r).cast("bigint")
        member = F.floor(F.col("block") / span).cast("bigint")
        group = F.floor(member / FANOUT).cast("bigint")
        wide = lambda m: F.least(span, F.col("blocks") - m * span)
        state = _swap(
            state.select(
                *(c for c in _STATE if c not in ("lane", "width")),
                (F.col("block") % span).alias("lane"),
                wide(member).alias("width"),
                F.col("rank").alias("rank_key"),
                group.alias("group"),
                (member % FANOUT).alias("place"),
                wide(group * FANOUT).alias("lanes"),
                (F.col("blocks") > span).alias("active"),
            )
        )
    state = state.withColumns(
        {"subroot": F.col("node"), "lane": F.col("block"), "width": F.col("blocks")}
    )
    for q in range(_rounds(ranks)):
        member = F.floor(F.col("rank") / FANOUT**q).cast("bigint")
        group = F.floor(F.col("rank") / FANOUT ** (q + 1)).cast("bigint")
        widths = sizes.groupBy(member.alias("m")).agg(F.sum("blocks").alias("w"))
        group_of = F.floor(F.col("m") / FANOUT).cast("bigint").alias("group")
        lanes = widths.groupBy(group_of).agg(F.max("w").alias("lanes"))
        state = state.withColumns({"group": group, "place": member % FANOUT, "rank_key": zero})
        state = _swap(state.join(lanes, "group").withColumn("active", F.lit(True)))
    return state.select("rank", "block", "subroot", F.col("node").alias("root"), "levels")


def _hex(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _subtree_proofs(leaves: list[str], whole: bool) -> tuple[list[str], list[list[int]], list[list[int]]]:
    """Siblings, places and run sizes of every leaf inside its block."""
    levels, nodes = [], leaves
    while len(levels) < BLOCK_LEVELS and (len(nodes) > 1 or not whole):
        runs = ["".join(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        levels.append(runs)
        nodes = [_hex(run) for run in runs]
    above = [("", [], [])] * len(nodes)
    for runs in reversed(levels):
        below = []
        for run, (proof, places, sizes) in zip(runs, above, strict=True):
            size = len(run) // _DIGITS
            for j in range(size):
                siblings = run[: j * _DIGITS] + run[(j + 1) * _DIGITS :]
                below.append((siblings + proof, [j, *places], [size, *sizes]))
        above = below
    proofs, places, sizes = zip(*above, strict=True)
    return list(proofs), list(places), list(sizes)


def _proofs(kept: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, subroot, root, levels = (batch.column(c)[i].as_py() for c in range(4))
                rows = batch.column(4)[i].values
                leaves = rows.field("leaf").to_pylist()
                proofs, places, sizes = _subtree_proofs(leaves, block == 0 and len(leaves) < BLOCK_ROWS)
                upper = "".join("".join(v["nodes"][: v["place"]] + v["nodes"][v["place"] + 1 :]) for v in levels)
                upper_places = [v["place"] for v in levels]
                upper_sizes = [len(v["nodes"]) for v in levels]
                n = len(leaves)
                # Bounded parts, since a proof takes a kilobyte for each level.
                for at in range(0, n, 512):
                    part = slice(at, at + 512)
                    m = len(leaves[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(rows.field(f"k{c}").slice(at, m) for c in range(kept)),
                            pa.array(leaves[part]),
                            pa.array([subroot] * m, pa.string()),
                            pa.array([root] * m, pa.string()),
                            pa.array([p + upper for p in proofs[part]]),
                            pa.array([p + upper_places for p in places[part]], pa.list_(pa.int32())),
                            pa.array([s + upper_sizes for s in sizes[part]], pa.list_(pa.int32())),
                        ],
                        names=names,
                    )

    return run


def merkle_manifest(
    df: DataFrame,
    fields: Sequence[str],
    source: str = "source",
    row_id: str = "doc_id",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``keep``, ``leaf``, ``subroot``, ``root``, ``proof``, ``places`` and ``runs`` of every row.

    A leaf is the digest of the ``fields``, by ``digest_of``. The leaves of a source
    ascend by id, a missing id first; ties come in the order of their digests, and
    equal rows are leaves of their own. While several nodes remain, every ``FANOUT``
    consecutive ones become one; the last is the source's ``subroot``, a lone leaf
    itself. The subroots, a missing source first and then by their bytes, lead to
    ``root`` in the same way. ``root_from_proof`` says what ``proof``, ``places`` and
    ``runs`` hold.

    Ids may be of any type that has an order. Sources compare as strings. Texts are
    read where they are and only digests travel, a long text thus costs no more; ``keep``
    columns travel, so they should be short. Other columns may have any name, a result
    replaces a kept column of its name. An empty table gives an empty result.
    """
    spark = df.sparkSession
    scratch = scratch_dir(spark, "merkle")
    bound_batches(spark)
    keep = without(keep, ["leaf", "subroot", "root", "proof", "places", "runs"])
    kept = [f"k{i}" for i in range(len(keep))]
    df.select(
        col(source).cast("string").alias("source"),
        col(row_id).alias("id"),
        digest_of([col(c) for c in fields]).alias("leaf"),
        # Parts rows that are equal otherwise, so that partitions can divide them.
        F.monotonically_increasing_id().alias("tie"),
        *(col(c).alias(k) for c, k in zip(keep, kept, strict=True)),
    ).write.parquet(f"{scratch}/leaves")
    rows = _sorted_rows(spark.read.parquet(f"{scratch}/leaves"), f"{scratch}/sorted")
    _blocks(rows).write.parquet(f"{scratch}/blocks")
    blocks = spark.read.parquet(f"{scratch}/blocks")
    _upper(blocks).write.parquet(f"{scratch}/upper")
    joined = blocks.select("rank", "block", "rows").join(
        spark.read.parquet(f"{scratch}/upper"), ["rank", "block"]
    )
    schema = df.select(*(col(c) for c in keep)).schema
    for field in spark.createDataFrame([], _ADDED).schema:
        schema.add(field)
    inputs = joined.select("block", "subroot", "root", "levels", "rows")
    return inputs.mapInArrow(_proofs(len(keep), schema.names), schema)
