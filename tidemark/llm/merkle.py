"""A Merkle manifest of a table: one root that vouches for every row, and for each row the proof that leads to it.

Nodes of a tree are numbered in order and cut into aligned blocks of ``8 ** 3``. A block is one row that keeps each of its levels as
one string of hexadecimal digests: fixed-width substrings of a level are hashed to the digests of the next one, and what
flanks a node inside its run of eight is its segment of the proof. The roots of blocks are the nodes of the next, much smaller
tree, and so on; the roots of all groups are the leaves of one last tree. Proofs are then handed down, block by block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path, stage

#: Nodes that one parent hashes, digits of a digest, and levels that a block climbs.
FANOUT, WIDTH, LEVELS = 8, 64, 3
BLOCK = FANOUT**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

SEGMENT = "struct<left:string,right:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def leaf(fields: dict[str, Column] | list[str] | tuple[str, ...]) -> Column:
    """Digest of a row: of each field ``-`` if null, else its UTF-8 byte count, a colon and its value as text."""
    columns = list(fields.values()) if isinstance(fields, dict) else [F.col(f"`{name}`") for name in fields]
    texts = [column.cast("string") for column in columns]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof: each level hashes the node between its flanking segments."""
    return F.aggregate(proof, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one string: level by level, left to right."""
    return F.aggregate(proof, F.lit(""), lambda text, s: F.concat(text, s["left"], s["right"]))


def numbered(rows: DataFrame, group: str, order: list[str], label: str, work: str) -> DataFrame:
    """Add ``rank``, from 0 within each ``group``, by ``order``: rows are sorted in ranges and each range gets its offset.

    A group with most of the rows lies in many ranges. Only the number of rows for each range and group is gathered.
    """
    ranges = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranges = ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_seq"))
    ranges = stage(ranges, f"{label}-ranges", work)
    counts = ranges.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    ranked = ranges.join(offsets, ["_range", group])
    return ranked.withColumn("rank", F.col("_before") + F.col("_seq") - F.col("_first")).drop("_range", "_seq", "_first", "_before")


def _parents(level: Column) -> Column:
    """The next level of a string of digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (FANOUT * WIDTH)).cast("int") - 1)
    digests = F.transform(runs, lambda i: F.sha2(F.substring(level, i * (FANOUT * WIDTH) + 1, F.lit(FANOUT * WIDTH)), 256))
    return F.array_join(digests, "").cast("binary")


def _levels(level: Column, several: Column, left: int = LEVELS) -> Column:
    """The levels of a block from the given one up. In a tree of ``several`` blocks every block climbs all; a lone one stops at its root."""
    if not left:
        return F.array(level)
    upwards = lambda: F.concat(F.array(level), let(_parents(level), lambda parents: _levels(parents, several, left - 1)))
    return F.when(several | (F.length(level) > WIDTH), upwards()).otherwise(F.array(level))


def _segments(levels: Column, slot: Column) -> Column:
    """For each level but a block's last: the digests before and after the node inside its run."""

    def segment(level: Column, k: Column) -> Column:
        at = F.floor(slot / F.pow(F.lit(FANOUT), k)).cast("int")
        start = at - at % FANOUT
        text = lambda first, count: F.substring(level, first * WIDTH + 1, count * WIDTH).cast("string")
        return F.struct(text(start, at - start).alias("left"), text(at + 1, start + FANOUT - 1 - at).alias("right"))

    inner = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(inner, segment)


def _climb(nodes: DataFrame, group: str, label: str, work: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round (``group, block, levels, members``) and the ``root`` of each group.

    ``nodes`` hold ``group, rank, digest`` and ``row``, a struct of what travels with them.
    """
    rounds: list[DataFrame] = []
    while True:
        placed = nodes.select(
            group,
            F.expr(f"rank div {BLOCK}").alias("block"),
            F.struct((F.col("rank") % BLOCK).cast("int").alias("slot"), "digest", "row").alias("member"),
        )
        # members are ordered by their slots, which differ
        blocks = placed.groupBy(group, "block").agg(F.array_sort(F.collect_list("member")).alias("members"))
        # only a group's first block has to be told whether there are others
        firsts = placed.groupBy(group).agg(F.max("block").alias("_last")).withColumn("block", F.lit(0).cast("long"))
        blocks = blocks.join(firsts, [group, "block"], "left")
        bottom = F.array_join(F.col("members.digest"), "").cast("binary")
        several = F.coalesce(F.col("_last") > 0, F.lit(True))
        blocks = blocks.withColumn("levels", let(bottom, lambda level: _levels(level, several))).withColumn("several", several).drop("_last")
        blocks = stage(blocks, f"{label}-{len(rounds)}", work)
        rounds.append(blocks)
        tops = blocks.select(group, "block", "several", F.element_at("levels", -1).cast("string").alias("digest"))
        if tops.where("several").isEmpty():
            return rounds, tops.select(group, F.col("digest").alias("root"))
        nodes = tops.select(group, F.col("block").alias("rank"), "digest", F.struct("block").alias("row"))


def _descend(rounds: list[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """``group, row, digest, proof`` and what else ``above`` has. ``above``: for each group its ``proof`` beyond its own root."""
    path = above.withColumn("block", F.lit(0).cast("long"))
    extra = [c for c in above.columns if c not in (group, "proof")]
    for k in range(len(rounds) - 1, -1, -1):
        held = rounds[k].join(path, [group, "block"])
        member = held.select(group, "levels", "proof", *extra, F.explode("members").alias("m"))
        proof = F.concat(_segments(F.col("levels"), F.col("m.slot")), F.col("proof"))
        path = member.select(group, F.col("m.row").alias("row"), F.col("m.digest").alias("digest"), proof.alias("proof"), *extra)
        if k:
            path = path.select(group, F.col("row.block").alias("block"), "proof", *extra)
    return path


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None, work: str | None = None) -> DataFrame:
    """For every row: ``row`` (a struct of ``key`` and of the columns to ``carry``), ``leaf``, ``subroot``, ``root`` and ``proof``.

    A row's leaf is the digest of its ``fields``. The leaves of each value of ``group`` form a tree in the order of ``key``; the trees'
    roots, in the order of ``group`` (null first, else by UTF-8 bytes), form another, whose root is ``root``. ``proof`` is an array of
    the digests to the left and right of each node on the way, for :func:`fold`. A null key is the least; rows of equal keys
    stand in the order of their leaves, and equal rows are interchangeable. A null and an empty text differ. An empty
    table has no rows and no root. Other columns, whatever their names, are not looked at. Nodes and blocks are written below
    ``work`` (default: a new scratch folder), which the result reads: remove it when the result has been used.
    """
    work = work or scratch_path(docs.sparkSession, "manifest")
    name = F.col(f"`{group}`").cast("string")
    travel = F.struct(F.col(f"`{key}`").alias(key), *[column.alias(alias) for alias, column in (carry or {}).items()])
    rows = docs.select(
        # null before all texts, which keep their order
        F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name)).alias("g"),
        F.col(f"`{key}`").alias("k"),
        leaf(fields).alias("digest"),
        travel.alias("row"),
    )
    rows = stage(rows, "leaves", work)
    rounds, subroots = _climb(numbered(rows, "g", ["k", "digest"], "leaf", work).drop("k"), "g", "block", work)

    # the last tree has a single group; its leaves carry the groups' names
    tops = subroots.select(F.lit(0).alias("all"), F.col("root").alias("digest"), F.struct("g").alias("row"), F.col("g").alias("k"))
    upper, root = _climb(numbered(stage(tops, "subroots", work), "all", ["k"], "root", work).drop("k"), "all", "top", work)
    above = root.select("all", "root", F.array().cast(f"array<{SEGMENT}>").alias("proof"))
    trees = _descend(upper, "all", above).select(F.col("row.g").alias("g"), F.col("digest").alias("subroot"), "root", "proof")
    return _descend(rounds, "g", trees).select("row", F.col("digest").alias("leaf"), "subroot", "root", "proof")
