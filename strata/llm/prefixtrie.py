"""Prefix trie of conversations, built by halving depths.

A level cuts every sequence of a trie at half of the trie's depth. What lies before the cut
stays in the upper trie; what lies behind it belongs to a lower trie, named by the upper
trie's name and the prefix up to the cut. Upper and lower tries are half as deep and are
cut in the same step of the next level, all of them at once, so a trie of depth D takes log2(D) steps.
In the end a trie is one turn deep and a node is known by its trie's name and its turn.
Totals go up the same way: a step adds what a lower trie's members carry to the place of the
cut, from the smallest tries to the largest.

Steps look at blocks of 1,024 turns of a conversation; cuts beyond a block are made on one row
a block, so no task holds a whole long conversation. A turn's place comes from a range
sort of all turns and the number of turns before it, not from a sort inside a conversation. Nodes are
grouped with sums and minima, which combine before the shuffle.

Turns and prefixes are named by 128-bit MD5 and by pairs of 64-bit hashes.

Defined cases: rows without a conversation id belong to none and are left out; turns come in
order of their number, without one first, equal ones by role and text, so repeated rows are
turns of their own; a NULL role or text is empty; a conversation without turns is a member of
the root only; an empty table has no node. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.llm.store import stored

#: Turns of a conversation in one block, a power of two.
BLOCK = 1 << 10
#: Conversations of neighbouring ids whose names are joined before the digest.
ENDS_BLOCK = 1 << 12
#: Of the reassembly: conversations in a group, and the bound of the shared turns.
GROUP, SHARED = 5, 9


def in_order(turns: DataFrame, conversation: str, *order: str) -> DataFrame:
    """The turns with ``pos``, their place in the conversation from 0 on, and ``turns``, its length."""
    sort = [F.col(conversation), *[F.col(c).asc_nulls_first() for c in order]]
    parts = max(turns.sparkSession.sparkContext.defaultParallelism, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = turns.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    # fixed by being stored: partition in the upper bits, row of the partition in the lower 33
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    held = placed.groupBy(conversation, part.alias("part")).agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    # a row for each conversation and partition, of which only hot conversations have several
    before = Window.partitionBy(conversation).orderBy("part")
    bases = held.withColumns({"base": F.sum("n").over(before) - F.col("n"), "turns": F.sum("n").over(Window.partitionBy(conversation))})
    joined = placed.withColumn("part", part).join(bases.drop("n"), [conversation, "part"])
    return joined.withColumn("pos", F.col("base") + F.col("__at") - F.col("first")).drop("part", "__at", "first", "base")


def reassembled(turns: DataFrame) -> DataFrame:
    """``conv``, ``pos``, ``role``, ``text`` of conversations whose first turns come from their group's first.

    The first h turns of conversation c are those of c - c % 5 (none if that does not
    exist), h being crc32(c) % 9; behind them come c's own turns after its first h. ``pos`` counts from 1;
    place 0 of every conversation is the root's.
    """
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    named = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", *empty)
    placed = stored(in_order(named, "conv", "turn", "role", "text"), "placed")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    lengths = placed.groupBy("conv").agg(F.max("turns").alias("turns"))
    base = lengths.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    all_ = lengths.withColumns({"h": shared, "base": F.col("conv") - F.col("conv") % GROUP}).join(base, "base", "left")
    known = stored(all_.withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0)))), "conversations")
    own = placed.drop("turns").join(known.select("conv", "h", "taken"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("pos"), "role", "text")
    first = placed.where(F.col("pos") < SHARED - 1).select(F.col("conv").alias("base"), "pos", "role", "text")
    lent = known.where("taken > 0").select("conv", "base", "taken").join(first, "base").where("pos < taken")
    root = known.select("conv", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"))
    return own.unionByName(lent.select("conv", (F.col("pos") + 1).alias("pos"), "role", "text")).unionByName(root)


def _content(own: Column) -> list[Column]:
    """Two hashes of turns with their offsets; the bitwise sum over a run of turns names the run."""
    return [F.xxhash64(F.lit(seed), F.col("off"), own) for seed in (1, 2)]


def _halves(off: Column, half: int) -> tuple[Column, Column]:
    """The part of a trie that a turn is in, and whether it lies behind the cut."""
    return F.floor(off / (2 * half)), off.bitwiseAND(F.lit(half)) != 0


def _named(rows: DataFrame, keys: list[str], hashes: list[str], size: int) -> DataFrame:
    """The rows with ``trie``, the name of the prefix before them, cut level by level."""
    half = size // 2
    while half:
        run, behind = _halves(F.col("off"), half)
        window = Window.partitionBy(*keys, "run")
        cut = [F.bit_xor(F.when(~F.col("behind"), F.col(h))).over(window) for h in hashes]
        rows = rows.withColumns({"run": run, "behind": behind})
        rows = rows.withColumn("trie", F.when(F.col("behind"), F.md5(F.concat_ws(",", "trie", F.lit(half), *cut).cast("binary"))).otherwise(F.col("trie")))
        half //= 2
    return rows.drop("run", "behind")


def _grafted(rows: DataFrame, keys: list[str], totals: list[str], size: int) -> DataFrame:
    """Every row's totals with those of all rows behind it, from the smallest tries up."""
    half = 1
    while half < size:
        run, behind = _halves(F.col("off"), half)
        rows = rows.withColumns({"run": run, "behind": behind})
        window = Window.partitionBy(*keys, "run")
        # the total at the first place behind the cut holds all that is behind it
        lower = {c: F.max(F.when(F.col("off") % half == 0, F.when(F.col("behind"), F.col(c)))).over(window) for c in totals}
        rows = rows.withColumns({c: F.col(c) + F.when(F.col("behind"), F.lit(0)).otherwise(F.coalesce(v, F.lit(0))) for c, v in lower.items()})
        half *= 2
    return rows.drop("run", "behind")


def _power(size: int) -> int:
    return 1 << max(0, size - 1).bit_length()


def _tries(turns: DataFrame, deepest: int) -> DataFrame:
    """Turns with ``block``, ``off`` (place in the block) and ``trie``."""
    name = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    size = F.octet_length("text").cast("long")
    rows = turns.select("conv", "pos", name.alias("name"), size.alias("size"), F.shiftright("pos", BLOCK.bit_length() - 1).alias("block"), F.col("pos").bitwiseAND(F.lit(BLOCK - 1)).alias("off"))
    rows = rows.withColumns(dict(zip(("h1", "h2"), _content(F.col("name")))))
    if deepest < BLOCK:
        rows = rows.withColumn("trie", F.lit(""))
    else:
        blocks = rows.groupBy("conv", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
        blocks = blocks.withColumns({"off": F.col("block"), "trie": F.lit("")})
        blocks = blocks.withColumns(dict(zip(("h1", "h2"), _content(F.concat_ws(",", "b1", "b2")))))
        blocks = _named(blocks, ["conv"], ["h1", "h2"], _power(deepest // BLOCK + 1))
        rows = rows.join(blocks.select("conv", "block", "trie"), ["conv", "block"])
    dealt = rows.repartition("conv", "block")
    return _named(dealt, ["conv", "block"], ["h1", "h2"], min(_power(deepest + 1), BLOCK)).drop("h1", "h2")


_TOTALS = ["n_leaves", "saved_tokens"]


def _totals(rows: DataFrame, deepest: int) -> DataFrame:
    """Rows with the totals of their conversation from their place on, and whether the next row stands for a node."""
    keys, size = ["conv", "block"], min(_power(deepest + 1), BLOCK)
    following = F.lead("own").over(Window.partitionBy(*keys).orderBy("off"))
    rows = _grafted(rows.withColumn("next_own", following), keys, _TOTALS, size)
    if deepest < BLOCK:
        return rows.withColumn("next_own", F.coalesce("next_own", F.lit(False)))
    # the first row of a block holds its totals; blocks are grafted like turns
    heads = rows.where("off = 0").select("conv", "block", F.col("block").alias("off"), "own", *_TOTALS)
    above = _grafted(heads, ["conv"], _TOTALS, _power(deepest // BLOCK + 1))
    later = above.select("conv", (F.col("block") - 1).alias("block"), F.col("own").alias("later_own"), *[F.col(c).alias(f"later_{c}") for c in _TOTALS])
    joined = rows.join(later, keys, "left")
    summed = {c: F.col(c) + F.coalesce(f"later_{c}", F.lit(0)) for c in _TOTALS}
    last = F.coalesce("next_own", F.when(F.col("off") == BLOCK - 1, F.col("later_own")), F.lit(False))
    return joined.withColumns({**summed, "next_own": last})


_DIGEST = T.StructType([T.StructField("pos", T.LongType()), T.StructField("trie", T.StringType()), T.StructField("name", T.StringType()), T.StructField("ends_sha256", T.StringType())])


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids of conversations that end at a node, streamed in ascending order.

    Runs of neighbouring ids are joined first, so that a node at which very many conversations end
    comes as few rows; the digest itself takes one run after the other and holds none of them.
    """
    run = F.floor(F.col("conv") / ENDS_BLOCK)
    ids = F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",")
    runs = members.groupBy("pos", "trie", "name", run.alias("run")).agg(ids.alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, None
        done: list[tuple] = []
        for batch in batches:
            for *key, ids in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if key != node:
                    if held:
                        done.append((*node, held.hexdigest()))
                    node, held = key, hashlib.sha256(ids.encode())
                else:
                    held.update(b"," + ids.encode())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, d)) for d in done])
                done = []
        if held:
            done.append((*node, held.hexdigest()))
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, d)) for d in done])

    ordered = runs.repartition("pos", "trie", "name").sortWithinPartitions("pos", "trie", "name", "run")
    return ordered.select("pos", "trie", "name", "ids").mapInArrow(digest, _DIGEST)


def trie(turns: DataFrame) -> DataFrame:
    """The trie's nodes, of ``conv``, ``pos``, ``role``, ``text`` rows with a root row at place 0 of each ``conv``.

    A node is known by its depth and its least member. ``n_leaves`` and ``saved_tokens`` are totals of
    its subtree: nodes without children, and bytes of last texts that members share.
    """
    kept = stored(turns, "turns")
    deepest = kept.agg(F.max("pos")).first()[0] or 0
    named = stored(_tries(kept, deepest), "tries")
    key = ["pos", "trie", "name"]
    lengths = named.groupBy("conv").agg(F.max("pos").alias("deep"))
    ended = named.join(lengths, "conv").withColumn("ends", F.col("pos") == F.col("deep"))
    # stored, so that its join is between two shuffles, of which a hot node's can be split
    nodes = stored(named.groupBy(*key).agg(F.min("conv").alias("least"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    placed = stored(ended.join(nodes, key), "placed")
    # a node's own figures stand in the row of its least member
    own = F.col("conv") == F.col("least")
    # nobody goes on behind a leaf
    going_on = placed.where(~F.col("ends")).select(*key).distinct().withColumn("inner", F.lit(True))
    leaves = nodes.join(going_on, key, "left").where("inner is null").select(F.col("least").alias("conv"), "pos", F.lit(1).cast("long").alias("leaf"))
    rows = placed.join(leaves, ["conv", "pos"], "left").withColumns(
        {
            "own": own,
            "n_leaves": F.coalesce("leaf", F.lit(0)).cast("long"),
            "saved_tokens": F.when(own, (F.col("n_convs") - 1) * F.col("size")).otherwise(F.lit(0).cast("long")),
        }
    )
    totals = _totals(rows, deepest)
    # the row before a node's own one, in the same conversation, belongs to its parent
    sums = [F.sum(F.col("next_own").cast("long")).alias("n_children"), *[F.sum(c).alias(c) for c in _TOTALS]]
    summed = totals.groupBy(*key).agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *sums)
    parents = placed.select("conv", (F.col("pos") + 1).alias("pos"), F.col("least").alias("parent_conv_id"))
    linked = summed.join(parents.withColumnRenamed("conv", "conv_id"), ["conv_id", "pos"], "left")
    found = linked.join(_ends(placed.where("ends").select(*key, "conv")), key, "left")
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    return found.select("conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", *_TOTALS, ends)
