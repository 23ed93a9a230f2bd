"""Conversation prefix trie: sorted sequences, their LCPs, and range minima that give every prefix its members.

A turn is the SHA-256 of its role and text; a conversation is the sequence of these, and only they and the lengths of the
texts are moved. Sequences are sorted (range partitions), numbered, and dealt into blocks of ``BLOCK`` neighbours, each
with the row before and the row behind it. In a block, the longest common prefixes of neighbours are laid out in a sparse
table of minima. A prefix is a candidate at the first sequence that has it; it looks for the left and the right end of its
members by two binary searches over the table, each on its own, without a stack. Everything a node needs of its subtree
is then a difference of running sums over its members: the leaves, as the sequences that their successor does not go on
from, and the characters below it, once for all members and once for what each member adds to its predecessor. Prefixes
that reach over a block's border are added up by their own digest: at most one path for each border.

No row and no task holds more than ``SEGMENT`` turns of a conversation. Conversations that go on are cut: those that share
their whole first segment with others form a trie of their next segments below it, and so on; one that shares it with
nobody is a chain from there. So a hot conversation is spread over many tasks, and a group of equal conversations over
many blocks. The ids of the members that end at a node are joined in order within the blocks; what is left for one task
is to run the digest over these strings, which takes no memory.

Turns are ordered by ``turn`` (NULL first), then by digest. NULL role or text becomes empty; repeated turns are turns of
their own. Rows without ``conv_id`` belong to no conversation and are left out. An empty table has no conversations and so
no nodes. Columns besides ``conv_id``, ``turn``, ``role`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sources.folders import Scratch
from .common import whole

SEGMENT = 512
BLOCK = 2048
GROUP, SHARED = 100, 6
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
PIECE = f"{NODE}, key binary, parent_key binary, tree long, block long, ends string, ends_sha256 string"
NOBODY = sha256(b"").hexdigest()


def positions(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos (1, 2, 3 ...), digest and chars of every turn that has a ``conv_id``."""
    role, text = whole(F.col("role")), whole(F.col("text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(marked, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    # A long conversation lies in many range partitions, so its turns are counted by all of them.
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("digest"), F.col("chars")]
    numbered = number_rows(rows, order, "_number", scratch)
    first = numbered.groupBy("conv_id").agg(F.min("_number").alias("_first"))
    return numbered.join(first, "conv_id").select("conv_id", (F.col("_number") - F.col("_first") + 1).alias("pos"), "digest", "chars")


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id and n_turns of positions."""
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def rebuilt(turns: DataFrame, scratch: Scratch, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Positions and conversations in which c begins with the first h turns of c - c % ``group`` instead of its own first
    h turns, where h is the CRC-32 of c modulo ``shared``. A conversation may lose all its turns."""
    rows = scratch.keep(positions(turns, scratch), "positions")
    own = conversations(rows)
    known = own.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared,
        "base": F.col("conv_id") - F.col("conv_id") % group,
    })
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("_base_turns"))
    known = known.join(lengths, "base", "left").withColumn("_head", F.least("h", F.coalesce("_base_turns", F.lit(0))))
    known = scratch.keep(known.drop("_base_turns"), "rebuilt")
    heads = rows.where(F.col("pos") < shared).withColumnRenamed("conv_id", "base").join(
        known.select("conv_id", "base", "h"), "base"
    ).where("pos <= h").select("conv_id", "pos", "digest", "chars")
    tails = rows.join(known.select("conv_id", "h", "_head"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("_head")).alias("pos"), "digest", "chars"
    )
    convs = known.select("conv_id", (F.col("_head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"))
    return scratch.keep(heads.unionByName(tails), "sequences"), convs


def common_prefix(one, other) -> int:
    n = min(len(one), len(other))
    return next((i for i in range(n) if one[i] != other[i]), n)


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: entry i of level j is the smallest of the 2**j values from i on."""
    levels = [values]
    while 2 << len(levels) - 1 <= len(values):
        half = 1 << len(levels) - 1
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def leftmost(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first sequence that shares ``depth`` turns with the one at ``at``; lcp[i] belongs to i - 1 and i."""
    at = at.copy()
    for j in reversed(range(len(levels))):
        reach = at - (1 << j)
        step = (reach >= 0) & (levels[j][np.clip(reach + 1, 0, len(levels[j]) - 1)] >= depth)
        at[step] = reach[step]
    return at


def rightmost(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last sequence that shares ``depth`` turns with the one at ``at``."""
    at, n = at.copy(), len(levels[0])
    for j in reversed(range(len(levels))):
        reach = at + (1 << j)
        step = (reach < n) & (levels[j][np.clip(at + 1, 0, len(levels[j]) - 1)] >= depth)
        at[step] = reach[step]
    return at


def smallest(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest value from left to right, both included."""
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), dtype=levels[0].dtype)
    for j in np.unique(level):
        of = level == j
        out[of] = np.minimum(levels[j][left[of]], levels[j][right[of] - (1 << j) + 1])
    return out


def _chain(tree: int, digests, depth: int) -> list[bytes]:
    """Digests of the prefixes of 0 to ``depth`` turns in a tree."""
    running = sha256(str(tree).encode() + b"/")
    found = [running.digest()]
    for digest in digests[:depth]:
        running.update(digest)
        found.append(running.digest())
    return found


def _block_nodes(above: int, block_rows: int, segment: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The nodes of a block, or their pieces, ``above`` turns below the conversations' beginnings."""

    def describe(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_number", ignore_index=True)
        block = int(rows["_block"].iloc[0])
        keys, trees = list(rows["keys"]), rows["tree"].to_numpy()
        between = np.array([-1] + [
            common_prefix(keys[i - 1], keys[i]) if trees[i - 1] == trees[i] else -1 for i in range(1, len(rows))
        ] + [-1])
        # Without the neighbours at both ends.
        place = rows["_number"].to_numpy() - 1 - block * block_rows
        begin, end = np.searchsorted(place, [0, block_rows])
        if begin == end:  # only a neighbour: there is no such block
            kinds = (column.split() for column in PIECE.split(", "))
            return pd.DataFrame({name: np.array([], dtype="int64" if kind == "long" else object) for name, kind in kinds})
        lcp, following = between[begin:end].copy(), between[begin + 1 : end + 1]
        if not begin:
            lcp[0] = -1
        rows, keys, trees = rows.iloc[begin:end], keys[begin:end], trees[begin:end]
        ids, sizes, n = rows["conv_id"].to_numpy(), np.array([len(k) for k in keys]), end - begin

        # Candidates: the prefixes that a sequence does not share with the one before it in the block.
        before, after, inside = lcp[0], following[-1], lcp.copy()
        inside[0] = -1
        start = inside + 1
        count = sizes - start + 1
        offset = np.cumsum(count) - count
        owner = np.repeat(np.arange(n), count)
        depth = np.arange(len(owner)) - offset[owner] + start[owner]
        levels = minima(inside)
        left, right = leftmost(levels, owner, depth), rightmost(levels, owner, depth)

        parent = np.arange(len(owner)) - 1
        opening = np.flatnonzero((count > 0) & (start > 0))
        at = leftmost(levels, opening, inside[opening])
        parent[offset[opening]] = offset[at] + inside[opening] - start[at]
        parent[depth == 0] = -1

        def summed(values: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(values)])
            return running[right + 1] - running[left]

        # Characters of the first turns of each sequence, sequences laid end to end.
        lengths = [np.concatenate([[0], np.cumsum(np.asarray(c, dtype=np.int64))]) for c in rows["chars"]]
        laid = np.concatenate(lengths)
        origin = np.cumsum(sizes + 1) - (sizes + 1)
        total = laid[origin + sizes]
        added = total - laid[origin + np.maximum(lcp, 0)]
        outside = laid[origin[owner] + np.maximum(depth - 1, 0)]
        begins = ~((owner == 0) & (depth <= before))
        members = right - left + 1
        own = summed(added) + np.where(begins, total[owner] - outside - added[owner], 0)
        saved = summed(total) - members * outside - own + summed(rows["more_saved"].to_numpy())
        leaves = summed((following < sizes).astype(np.int64)) + summed(rows["more_leaves"].to_numpy())
        children = np.bincount(parent[begins & (depth > 0)], minlength=len(owner))
        children = children + np.where(depth == segment, summed(rows["more_children"].to_numpy()), 0)
        least = smallest(minima(ids), left, right)

        # The paths that go on in the blocks before and behind this one.
        key = np.full(len(owner), None, dtype=object)
        for of, shared, digests in (
            ((owner == 0) & (depth <= before), before, keys[0]), ((right == n - 1) & (depth <= after), after, keys[-1]),
        ):
            chain = _chain(trees[left[of][0]], digests, shared) if of.any() else []
            for c in np.flatnonzero(of):
                key[c] = chain[depth[c]]

        # Members that end here: the sequence itself and its equals, which follow it directly.
        ends, goes_on = np.full(len(owner), "", dtype=object), rows["goes_on"].to_numpy()
        last = rightmost(levels, np.arange(n), sizes)
        for i in np.flatnonzero(count):
            equal = slice(i, last[i] + 1)
            here = ids[equal][(sizes[equal] == sizes[i]) & ~goes_on[equal]]
            ends[offset[i] + count[i] - 1] = ",".join(map(str, here.tolist()))

        below_root = (depth == 1) & (above > 0)
        unknown = (parent < 0) | ((np.array([k is not None for k in key])[parent]) & ~below_root)
        parent_id = np.where(below_root, rows["root_id"].to_numpy()[owner], least[parent])
        return pd.DataFrame({
            "conv_id": least, "depth": depth + above, "parent_conv_id": pd.arrays.IntegerArray(parent_id.astype(np.int64), unknown),
            "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "key": key,
            "parent_key": [key[p] if u and p >= 0 else None for p, u in zip(parent, unknown)], "tree": trees[owner], "block": block,
            "ends": [e if k is not None else "" for e, k in zip(ends, key)],
            "ends_sha256": [sha256(e.encode()).hexdigest() if k is None else None for e, k in zip(ends, key)],
        })

    return describe


def _end_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each key's strings, joined by commas, from rows sorted by key and block."""
    last, running = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch["key"], batch["ends"]):
            if key == last:
                running.update(b",")
            else:
                if running is not None:
                    done.append((last, running.hexdigest()))
                last, running = key, sha256()
            running.update(ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends_sha256"])
    if running is not None:
        yield pd.DataFrame([(last, running.hexdigest())], columns=["key", "ends_sha256"])


def _nodes(rows: DataFrame, above: int, scratch: Scratch, segment: int, block: int) -> DataFrame:
    """The nodes of numbered rows: NODE, ends_sha256 and tree."""
    at = F.floor((F.col("_number") - 1) / block)
    blocks = F.filter(
        F.array(at, F.when(F.col("_number") % block == 0, at + 1), F.when(F.col("_number") % block == 1 % block, at - 1)),
        lambda b: b >= 0,
    )
    dealt = rows.withColumn("_block", F.explode(blocks))
    found = scratch.keep(dealt.groupBy("_block").applyInPandas(_block_nodes(above, block, segment), PIECE), "pieces")
    parts = found.where("key IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.min(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "parent_key", "tree")]
    ended = parts.where("ends <> ''").select("key", "block", "ends").repartition("key").sortWithinPartitions("key", "block")
    ended = ended.mapInPandas(_end_digests, "key binary, ends_sha256 string")
    merged = parts.groupBy("key").agg(*sums, *same).join(ended, "key", "left")
    merged = scratch.keep(merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY))), "merged")
    columns = [c.split()[0] for c in NODE.split(", ")] + ["ends_sha256", "tree"]
    everything = found.where("key IS NULL").drop("block", "ends").unionByName(merged)
    over = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_over"))
    placed = everything.where("parent_key IS NOT NULL").join(over, "parent_key").withColumn("parent_conv_id", F.col("_over"))
    return everything.where("parent_key IS NULL").select(*columns).unionByName(placed.select(*columns))


def _chains(rows: DataFrame, alone: DataFrame, above: int) -> DataFrame:
    """The nodes more than ``above`` turns deep of conversations that share no such prefix."""
    last = F.col("pos") == F.col("n_turns")
    digest = F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOBODY))
    parent = F.when(F.col("pos") == above + 1, F.col("root_id")).otherwise(F.col("conv_id"))
    return rows.where(F.col("pos") > above).join(alone.select("conv_id", "n_turns", "root_id"), "conv_id").select(
        "conv_id", F.col("pos").cast("long").alias("depth"), parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), digest.alias("ends_sha256"),
    )


def trie(rows: DataFrame, convs: DataFrame, scratch: Scratch, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """NODE and ends_sha256 of every node.

    ``rows`` holds conv_id, pos, digest and chars of all turns, ``convs`` conv_id and n_turns of all conversations, those
    without turns included; both are read several times and should be stored tables.
    """
    longest = convs.agg(F.max("n_turns")).first()[0] or 0
    none = F.array().cast("array<binary>"), F.array().cast("array<bigint>")
    alive, levels = convs.withColumns({"tree": F.lit(0).cast("long"), "root_id": F.lit(0).cast("long")}), []
    found = []
    while True:
        above = segment * len(levels)
        inside = rows.where((F.col("pos") > above) & (F.col("pos") <= above + segment))
        gathered = inside.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("_turns"))
        cut = alive.join(gathered, "conv_id", "left").select(
            "conv_id", "tree", "root_id", "n_turns", F.coalesce(F.col("_turns.digest"), none[0]).alias("keys"),
            F.coalesce(F.col("_turns.chars"), none[1]).alias("chars"), (F.col("n_turns") > above + segment).alias("goes_on"),
        )
        numbered = number_rows(cut, [F.col("tree"), F.col("keys"), F.col("conv_id")], "_number", scratch)
        if longest <= above + segment:
            levels.append((above, numbered, None))
            break
        # Whoever has the whole segment is a member of the node at its end, also one that goes no further.
        full = numbered.where(F.size("keys") == segment).select("conv_id", "tree", "keys", "n_turns", "goes_on")
        together = full.groupBy("tree", "keys").agg(
            F.count_if("goes_on").alias("_n"), F.min(F.when(F.col("goes_on"), F.col("conv_id"))).alias("_least"),
            F.min("conv_id").alias("root_id"),
        )
        onward = full.where("goes_on").join(together, ["tree", "keys"])
        onward = scratch.keep(onward.select("conv_id", "n_turns", "_n", "_least", "root_id"), "onward")
        levels.append((above, numbered, onward))
        found.append(_chains(rows, onward.where("_n = 1"), above + segment))
        alive = onward.where("_n > 1").select("conv_id", "n_turns", F.col("_least").alias("tree"), "root_id")
        longest = alive.agg(F.max("n_turns")).first()[0] or 0
        if not longest:
            break

    # From the deepest trees up: what lies below a tree's root is added where its first member stands.
    roots = None
    for above, numbered, onward in reversed(levels):
        zero = F.lit(0).cast("long")
        more = {"more_children": zero, "more_leaves": zero, "more_saved": zero}
        if onward is not None:
            alone = onward.where("_n = 1").select("conv_id", F.lit(1).cast("long").alias("_c"), zero.alias("_l"), zero.alias("_s"))
            if roots is not None:
                alone = alone.unionByName(roots.select(
                    F.col("tree").alias("conv_id"), F.col("n_children").alias("_c"), (F.col("n_leaves") - 1).alias("_l"),
                    F.col("saved_tokens").alias("_s"),
                ))
            numbered = numbered.join(alone, "conv_id", "left")
            more = {name: F.coalesce(c, zero) for name, c in zip(more, ("_c", "_l", "_s"))}
        nodes = scratch.keep(_nodes(numbered.withColumns(more), above, scratch, segment, block), "nodes")
        roots = nodes.where(F.col("depth") == above)
        found.append((nodes.where(F.col("depth") > above) if above else nodes).drop("tree"))
    return reduce(DataFrame.unionByName, found)


def prefix_trie(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The trie of conversations as they are."""
    scratch = scratch or Scratch(turns.sparkSession)
    rows = scratch.keep(positions(turns, scratch), "positions")
    return trie(rows, scratch.keep(conversations(rows), "conversations"), scratch)


def rebuilt_trie(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The trie of conversations that take over their first turns from the first one of their group."""
    scratch = scratch or Scratch(turns.sparkSession)
    rows, convs = rebuilt(turns, scratch)
    return trie(rows, scratch.keep(convs, "conversations"), scratch)
