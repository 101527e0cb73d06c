"""Prefix trie of conversations, from sorted sequences and their longest common prefixes.

Turns become 32-byte fingerprints of (role, text); a conversation is the array of its
turns' fingerprints.  Conversations are sorted by (array, conv_id) over all
partitions, so the members of every prefix stand side by side.  L[i] is the number of
turns that row i shares with the row before it.

A sorted partition is worked through in blocks of at most ``ROWS`` conversations and
about ``TURNS`` turns.  In a block a sparse table holds the minima of L over all
runs of 2^j rows.  A candidate prefix is (row, depth); its members are the rows
around it that L connects at that depth or deeper, and it finds both ends by itself:
one binary search to the left and one to the right over the sparse table, without a
stack and without the other candidates.

Everything about a node is a sum over its rows, hence over blocks:

- children: rows of the interval where a node one deeper begins;
- leaves: rows that the next row does not go on from (L of the next row is below
  their length);
- saved tokens: each member's words from the node's depth on, less the words of
  the subtree's nodes, counted where a node begins.

So a node inside one block is finished there.  Only a node that crosses a block's
border (a prefix of its first or last row) is emitted in parts, and the parts are
added up under a digest of the prefix.  The digest of a node's final members takes ids in order:
blocks send them as joined pieces, and one task streams a node's pieces.

What the driver holds: two numbers for each partition (L at its borders).

Defined cases: null role or text counts as empty; rows without a conversation id
belong to none and are left out; null turns come first; equal turns of one conversation are
ordered by their fingerprints and all stay; a conversation rebuilt without
turns is a member of the root; of a negative id the remainder has its sign, as in SQL;
an empty table has no root and gives an empty result; extra columns are ignored.  A
conversation is one array of 40 bytes a turn, whatever its texts' length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.spark import frozen, stored, table
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimate_bytes

#: Conversations, and about how many turns, a block holds at most.
ROWS = 8192
TURNS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, keys, words``: every conversation with the first turns of its twenty's first one."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"),
    )
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    heads = own.where(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    both = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    none = F.slice("own", 1, 0)
    whole = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own")))
    return both.select("conv_id", whole.alias("t")).select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def _shared(a: Column, b: Column) -> Column:
    """How many first elements two arrays share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def _borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Per partition: turns shared with the row before it and with the row after it (-1: no such row)."""
    ends = rows.groupBy("part").agg(
        F.min(F.struct("keys", "conv_id")).getField("keys").alias("first"), F.max(F.struct("keys", "conv_id")).getField("keys").alias("last")
    )
    order = Window.orderBy("part")  # one row per partition
    beside = ends.withColumn("before", F.lag("last").over(order)).withColumn("after", F.lead("first").over(order))
    found = beside.select(
        "part",
        F.when(F.col("before").isNull(), -1).otherwise(_shared(F.col("before"), F.col("first"))).alias("l"),
        F.when(F.col("after").isNull(), -1).otherwise(_shared(F.col("last"), F.col("after"))).alias("r"),
    )
    return {r["part"]: (r["l"], r["r"]) for r in found.collect()}


def sparse_minima(values: np.ndarray) -> list[np.ndarray]:
    """Level j holds, at place i, the least of ``values[i : i + 2**j]``."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def extents(levels: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that L (``levels[0]``) connects with ``row`` at ``depth`` or deeper."""
    n = len(levels[0])
    left, right = row.copy(), row.copy()
    for j in range(len(levels) - 1, -1, -1):
        step, least = 1 << j, levels[j]
        # L[right + 1 .. right + step], and L[left - step + 1 .. left]
        ok = right + step < n
        ok[ok] = least[right[ok] + 1] >= depth[ok]
        right[ok] += step
        ok = left - step >= 0
        ok[ok] = least[left[ok] - step + 1] >= depth[ok]
        left[ok] -= step
    return left, right


def _range_min(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    j = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for level in np.unique(j):
        at = j == level
        out[at] = np.minimum(levels[level][left[at]], levels[level][right[at] - (1 << level) + 1])
    return out


_NODE = (
    "open boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)
_NODE_TYPES = [
    ("open", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.string()),
]


class _Block:
    """Rows of a sorted block: ids, flat turn keys and words, and where each row's turns begin."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, words: np.ndarray, at: np.ndarray):
        self.ids, self.keys, self.words, self.at = ids, keys, words, at

    def turns(self, row: int) -> np.ndarray:
        return self.keys[self.at[row] : self.at[row + 1]]


def _shared_turns(a: np.ndarray, b: np.ndarray) -> int:
    m = min(len(a), len(b))
    differ = np.flatnonzero((a[:m] != b[:m]).any(1))
    return int(differ[0]) if len(differ) else m


def _lcps(block: _Block, before: int) -> np.ndarray:
    """L of the block's rows; ``before`` is that of the first."""
    sizes = np.diff(block.at)
    both = np.minimum(sizes[1:], sizes[:-1])
    starts = np.cumsum(both) - both
    place = np.arange(both.sum()) - np.repeat(starts, both)
    differ = np.flatnonzero((block.keys[np.repeat(block.at[1:-1], both) + place] != block.keys[np.repeat(block.at[:-2], both) + place]).any(1))
    nearest = np.append(differ, np.iinfo(np.int64).max)[np.searchsorted(differ, starts)]
    return np.concatenate([[before], np.minimum(nearest - starts, both)]).astype(np.int64)


def _prefix_digests(turns: np.ndarray, deepest: int) -> list[bytes]:
    """A digest for each of the first 0 to ``deepest`` turns."""
    running, out = hashlib.sha256(), []
    for d in range(deepest + 1):
        if d:
            running.update(turns[d - 1].tobytes())
        out.append(running.copy().digest())
    return out


def block_nodes(block: _Block, before: int, after: int) -> list[tuple]:
    """The nodes, or parts of nodes, of one block, as rows of ``_NODE``."""
    n = len(block.ids)
    sizes = np.diff(block.at)
    lcp = _lcps(block, before)
    levels = sparse_minima(lcp)
    # candidates: every prefix that begins at a row, and all of the first row's
    shallow = np.concatenate([[0], lcp[1:] + 1])
    per_row = np.maximum(0, sizes - shallow + 1)
    row = np.repeat(np.arange(n), per_row)
    depth = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row) + np.repeat(shallow, per_row)
    left, right = extents(levels, row, depth)
    begins = depth > lcp[left]  # else it has begun in an earlier block
    goes_on = (right == n - 1) & (after >= depth)
    is_open = ~begins | goes_on

    # candidates in order of depth, then row
    order = np.lexsort((row, depth))
    place = (depth * n + row)[order]
    fresh = place[begins[order]]
    n_children = np.searchsorted(fresh, (depth + 1) * n + right, "right") - np.searchsorted(fresh, (depth + 1) * n + left)
    up = np.where(depth > 0, order[np.maximum(0, np.searchsorted(place, (depth - 1) * n + left, "right") - 1)], -1)

    following = np.append(lcp[1:], after)
    leaf = np.concatenate([[0], np.cumsum(following < sizes)])
    n_leaves = leaf[right + 1] - leaf[left]

    upto = np.concatenate([[0], np.cumsum(block.words)])  # words before each turn
    total = np.concatenate([[0], np.cumsum(upto[block.at[1:]] - upto[block.at[:-1]])])
    new = upto[block.at[1:]] - upto[block.at[:-1] + np.clip(lcp, 0, None)]  # of the nodes that begin at a row
    added = np.concatenate([[0], np.cumsum(new)])
    above = upto[block.at[left] + np.maximum(depth - 1, 0)] - upto[block.at[left]]  # before the node's last turn
    n_convs = right - left + 1
    members = total[right + 1] - total[left] - n_convs * above
    own = np.where(begins, upto[block.at[left + 1]] - upto[block.at[left]] - above, new[left])
    saved = members - (added[right + 1] - added[left + 1]) - own

    least = _range_min(sparse_minima(block.ids), left, right)
    # the rows that end at a node stand first in it
    same = np.concatenate([[False], (lcp[1:] == sizes[1:]) & (sizes[1:] == sizes[:-1])])
    run_end = np.append(np.flatnonzero(~same)[1:], n)[np.cumsum(~same) - 1]
    deepest = [int(min(sizes[0], before)), int(min(sizes[-1], after))]
    digests = [_prefix_digests(block.turns(0), max(deepest[0], 0)), _prefix_digests(block.turns(n - 1), max(deepest[1], 0))]

    def key(c: int) -> bytes:
        return digests[0 if not begins[c] else 1][depth[c]]

    out = []
    for c in range(len(row)):
        i, d, parent = int(left[c]), int(depth[c]), int(up[c])
        ends = block.ids[i : run_end[i]].tolist() if sizes[i] == d else []
        joined = ",".join(map(str, ends))
        part = bool(is_open[c])
        far = parent >= 0 and bool(is_open[parent])
        out.append((
            part, key(c) if part else None, key(parent) if far else None, int(least[c]), d,
            int(least[parent]) if parent >= 0 and not far else None, int(n_convs[c]), int(n_children[c]), int(n_leaves[c]),
            int(saved[c]), None if part else hashlib.sha256(joined.encode()).hexdigest(), joined if part and ends else None,
        ))
    return out


def _blocks(batches: Iterable[pa.RecordBatch], rows: int, turns: int) -> Iterator[tuple[int, _Block]]:
    """(partition, block) in order; long batches are cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        keys, words = batch.column("keys"), batch.column("words")
        at = keys.offsets.to_numpy().astype(np.int64)
        flat = np.frombuffer(b"".join(keys.flatten().to_pylist()), "<u8").reshape(-1, 4)
        counts = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = at - at[0]
        ids = batch.column("conv_id").to_numpy()
        k = 0
        while k < len(ids):
            end = min(len(ids), k + rows, max(k + 1, int(np.searchsorted(at, at[k] + turns, "right")) - 1))
            yield part, _Block(ids[k:end], flat[at[k] : at[end]], counts[at[k] : at[end]], at[k : end + 1] - at[k])
            k = end


def _nodes(borders: dict[int, tuple[int, int]], rows: int, turns: int):
    def emitted(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(found), 16384):
            columns = zip(*found[k : k + 16384])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _NODE_TYPES)], names=[x for x, _ in _NODE_TYPES])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, part = None, -1, None
        for part, block in _blocks(batches, rows, turns):
            if held is None:
                before = borders[part][0]
            else:
                after = _shared_turns(held.turns(len(held.ids) - 1), block.turns(0))
                yield from emitted(block_nodes(held, before, after))
                before = after
            held = block
        if held is not None:
            yield from emitted(block_nodes(held, before, borders[part][1]))

    return run


def _streamed_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its pieces, which arrive in order."""
    key, running = None, None

    def row(k: bytes, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "digest"])

    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k == key:
                running.update(b"," + piece.encode())
                continue
            if running is not None:
                yield row(key, running)
            key, running = k, hashlib.sha256(piece.encode())
    if running is not None:
        yield row(key, running)


def trie_nodes(
    conversations: DataFrame, rows: int = ROWS, turns: int = TURNS, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """One row per distinct prefix: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    order = ["keys", "conv_id"]
    ranged = rebuilt(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = frozen(ranged.withColumn("part", F.spark_partition_id()))
    found = stored(ranged.mapInArrow(_nodes(_borders(ranged), rows, turns), _NODE), "trie-nodes")

    parts = found.where("open")
    first = F.split_part(F.col("ends"), F.lit(","), F.lit(1)).cast("long")
    pieces = parts.where(F.col("ends").isNotNull()).select("key", first.alias("first"), "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_streamed_digests, "key binary, digest string")
    whole = parts.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    whole = frozen(whole.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("digest", nothing)).drop("digest"))

    # open nodes are prefixes of blocks' border rows: few, but measured before they are broadcast
    names = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_p"))
    small = estimate_bytes(names)[1] <= max_broadcast_bytes
    names = F.broadcast(names) if small else names
    columns = ["depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = found.where(~F.col("open"))
    within = done.where(F.col("parent_key").isNull()).select("conv_id", "parent_conv_id", *columns)
    below = done.where(F.col("parent_key").isNotNull()).join(names, "parent_key").select("conv_id", F.col("_p").alias("parent_conv_id"), *columns)
    across = whole.join(names, "parent_key", "left").select("conv_id", F.col("_p").alias("parent_conv_id"), *columns)
    return within.unionByName(below).unionByName(across).select("conv_id", "depth", "parent_conv_id", *columns[1:])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(table(spark, sf_dir, "conversations"))


_CRC = (
    "xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split({x}, ''), "
    "lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
    "lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"
)
SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS s FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, s, {_CRC.format(x="CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
whole AS (
  SELECT h.conv_id, list_concat(coalesce(b.s, [])[1:h.h], h.s[h.h + 1:]) AS s
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
members AS (
  SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends FROM whole, unnest(range(0, len(s) + 1)) AS u(d)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM members GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.d = nodes.d AND kids.p = nodes.p),
under AS (
  SELECT u.k AS d, n.p[1:u.k] AS p, sum(n.saved) AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
  FROM full_ n, unnest(range(0, n.d + 1)) AS u(k) GROUP BY ALL)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, under.n_leaves,
  CAST(under.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN under ON under.d = f.d AND under.p = f.p
LEFT JOIN full_ up ON up.d = f.d - 1 AND up.p = f.p[1:f.d - 1]
"""
