"""A prefix trie of conversations in minimal-perfect-hash node tables (operator 13).

1. Turns are range-partitioned in the order of their conversations, so that a
   conversation of any length spreads over tasks. A task keeps running sums of
   turn digests times powers of an odd base; two numbers for each task's first
   and last conversation, folded on the driver, join the tasks. The sums are
   digests of prefixes, and digests of rebuilt conversations follow from them.
2. Distinct prefix digests are the nodes. Partially aggregated counts give each
   node's members; a node's depth and digest name it.
3. Nodes of one owner (the smallest member) with equally many members are a
   chain without branches or ends: only its ends matter to the tree, so a long
   conversation costs one row here. A chain of one conversation needs no tree.
4. Chains below a node that at most `members` conversations share are one
   shard's work, with the node's whole subtree; the shard is the hash of that
   node, the first on a conversation's path which is not in a bitmap of the
   nodes with more members. A shard enumerates its chains' digests, gives each
   a slot by a minimal perfect hash, checks the digest found in a slot against
   the one asked for, scatters counts into flat arrays and adds them up through
   the parents' slots, deepest chains first. What the shards' topmost chains
   hold is summed by parent and added up in the same way in the crown, the
   chains that more than `members` conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.tables import bitmap, empty, marked, place_of, stored
from gavel.llm.words import mixed

BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that powers have inverses
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "h1", "h2"]
EARLY = 3  # the most turns that one conversation takes over from another
PIECE = 256  # ids that are joined to one text before they are hashed


@dataclass(frozen=True)
class TrieParams:
    group: int = 20  # conversations c with the same c - c % group take over turns of the first
    members: int = 1024  # conversations below a node whose subtree is one shard's work
    bits: int = 22  # of the bitmap of nodes with more


# ---- prefix digests -------------------------------------------------------


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2**64."""
    out, square, e = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.astype(np.uint64)
    with np.errstate(over="ignore"):
        while e.any():
            out = np.where(e & np.uint64(1), out * square, out)
            square, e = square * square, e >> np.uint64(1)
    return out


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


SUMS = ["s1", "s2", "t1", "t2"]  # the prefix digest of a turn and of the turn before it
ORDERED = "conv long, head long, block int, i long, words long, run long, s1 long, s2 long, t1 long, t2 long, note int"


def _ordered_turns(turns: DataFrame, params: TrieParams) -> DataFrame:
    """Turns in order, with sums over the turns of the same conversation in the same task (a block).

    note 0: a turn; 1 and 2: the last turns of a block's first and last conversation, once more.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % params.group).alias("head"), F.col("conv_id").alias("conv"), "turn", digest.alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["head", "conv", "turn", "digest", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("head", "conv", "digest", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        conv_before, i_before, run_before, sums = None, 0, 0, [np.uint64(0)] * 2
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy(zero_copy_only=False)
            head = batch.column("head").to_numpy(zero_copy_only=False)
            words = batch.column("words").to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            length = np.diff(np.append(begin, len(conv)))
            same = conv_before is not None and conv[0] == conv_before  # goes on from the batch before
            i = np.arange(len(conv)) - np.repeat(begin, length) + 1
            run = np.cumsum(words)
            run = run - np.repeat(run[begin] - words[begin], length)
            if same:
                i[: length[0]] += i_before
                run[: length[0]] += run_before
            raw = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(len(conv), 4)
            cols = []
            with np.errstate(over="ignore"):
                for k in range(2):
                    term = raw[:, k] * _powers(BASE[k], i)
                    total = np.cumsum(term)
                    total = total - np.repeat(total[begin] - term[begin], length)
                    if same:
                        total[: length[0]] += sums[k]
                    cols.append((total, total - term))
            ends = np.append(begin[1:], len(conv)) - 1
            out = [conv, head, np.full(len(conv), block, np.int32), i, words, run, cols[0][0], cols[1][0], cols[0][1], cols[1][1]]
            yield _turns(out, np.zeros(len(conv), np.int32))
            if first is None or (same and first[0][0] == conv[0]):
                first = [x[ends[0] : ends[0] + 1] for x in out]
            last = [x[-1:] for x in out]
            conv_before, i_before, run_before, sums = conv[-1], i[-1], run[-1], [cols[0][0][-1], cols[1][0][-1]]
        for note, row in ((1, first), (2, last)):
            if row is not None:
                yield _turns(row, np.array([note], np.int32))

    return rows.mapInArrow(run, ORDERED)


def _turns(columns: list[np.ndarray], note: np.ndarray) -> pa.RecordBatch:
    arrays = [x.view(np.int64) if x.dtype == np.uint64 else x for x in columns]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (*arrays, note)], [x.split()[0] for x in ORDERED.split(", ")])


def _carried(ordered: DataFrame) -> dict[int, tuple]:
    """For each block whose first conversation began before: that conversation, its turns, words and sums so far.

    Two rows of each block reach the driver.
    """
    ends: dict[int, dict] = {}
    for r in ordered.where("note > 0").collect():
        ends.setdefault(r.block, {})[r.note] = r
    out, before = {}, None
    mask = (1 << 64) - 1
    for block in sorted(ends):
        first, last = ends[block][1], ends[block][2]
        goes_on = before is not None and before[0] == first.conv
        if goes_on:
            out[block] = before
        conv, i, run, sums = last.conv, last.i, last.run, (last.s1 & mask, last.s2 & mask)
        if goes_on and conv == first.conv:
            sums = tuple((x + pow(b, before[1], 1 << 64) * s) & mask for x, b, s in zip(before[3], BASE, sums))
            i, run = i + before[1], run + before[2]
        before = (conv, i, run, sums)
    return out


def _own_prefixes(ordered: DataFrame) -> DataFrame:
    """conv, head, pos, words, run, s1, s2, t1, t2 of every turn, over the whole conversation."""
    carried = _carried(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, block = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("conv", "block"))
            pos, total = (batch.column(x).to_numpy(zero_copy_only=False).copy() for x in ("i", "run"))
            sums = {x: _unsigned(batch, x).copy() for x in SUMS}
            for b in np.unique(block):
                if int(b) in carried:
                    before, turns, words, start = carried[int(b)]
                    at = (block == b) & (conv == before)
                    pos[at] += turns
                    total[at] += words
                    with np.errstate(over="ignore"):
                        for x in SUMS:
                            k = int(x[1]) - 1
                            sums[x][at] = sums[x][at] * np.uint64(pow(BASE[k], turns, 1 << 64)) + np.uint64(start[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("head"), pa.array(pos), batch.column("words"), pa.array(total), *(pa.array(sums[x].view(np.int64)) for x in SUMS)],
                ["conv", "head", "pos", "words", "run", *SUMS],
            )

    return ordered.where("note = 0").mapInArrow(run, "conv long, head long, pos long, words long, run long, s1 long, s2 long, t1 long, t2 long")


def _taken(conv: str) -> Column:
    """How many turns a conversation takes over."""
    return F.crc32(F.col(conv).cast("string").cast("binary")) % (EARLY + 1)


ROWS = "conv long, depth long, h1 long, h2 long, p1 long, p2 long, words long, run long, ends boolean"


def rebuilt(turns: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """conv, depth, h1, h2 (node), p1, p2 (its parent), words, run (words up to here), ends of every prefix of every
    rebuilt conversation, the empty one (depth 0) included; a stored table."""
    own = stored(_own_prefixes(stored(_ordered_turns(turns, params), "turns")), "prefixes")
    heads = own.groupBy("conv", "head").agg(
        F.max("pos").alias("size"),
        F.sort_array(F.collect_list(F.when(F.col("pos") <= EARLY, F.struct("pos", "words", "run", *SUMS)))).alias("early"),
    )
    heads = stored(heads, "heads")
    # A base conversation's first turns, a row for each conversation that takes them over.
    base = heads.select(F.col("conv").alias("head"), F.col("early").alias("base"))
    met = heads.withColumn("want", _taken("conv").cast("int")).join(base, "head", "left")
    base = F.coalesce("base", F.array().cast(heads.schema["early"].dataType))
    met = met.withColumn("base", F.slice(base, 1, F.greatest(F.col("want"), F.lit(0)))).withColumn("got", F.size("base"))
    met = stored(met, "taken")
    left_out = F.when(F.col("want") > 0, F.try_element_at("early", F.least("want", F.size("early").cast("int"))))
    joint = F.when(F.col("got") > 0, F.try_element_at("base", F.col("got")))
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    plan = stored(met.select(
        "conv", "size", "want", "got", zero(left_out["s1"]).alias("x1"), zero(left_out["s2"]).alias("x2"), zero(left_out["run"]).alias("x_run"),
        zero(joint["s1"]).alias("b1"), zero(joint["s2"]).alias("b2"), zero(joint["run"]).alias("b_run"),
    ).where("size > want"), "plans")
    tail = own.where(F.col("pos") > _taken("conv")).join(plan, "conv")
    back = [pow(b, -1, 1 << 64) for b in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in batch.schema.names}
            shift = col["want"] - col["got"]
            out = {}
            with np.errstate(over="ignore"):
                for k in (1, 2):
                    scale, base = _powers(back[k - 1], shift), _unsigned(batch, f"b{k}")
                    for name, x in (("h", "s"), ("p", "t")):
                        out[f"{name}{k}"] = (base + (_unsigned(batch, f"{x}{k}") - _unsigned(batch, f"x{k}")) * scale).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *(pa.array(x) for x in (
                    col["pos"] - shift, out["h1"], out["h2"], out["p1"], out["p2"], col["words"],
                    col["run"] - col["x_run"] + col["b_run"], col["pos"] == col["size"]))],
                ["conv", "depth", "h1", "h2", "p1", "p2", "words", "run", "ends"],
            )

    none = F.lit(0).cast("long")
    short = F.col("size") <= F.col("want")
    early = met.select("conv", "size", "want", "got", F.explode("base").alias("x")).select(
        "conv", F.col("x.pos").alias("depth"), F.col("x.s1").alias("h1"), F.col("x.s2").alias("h2"), F.col("x.t1").alias("p1"),
        F.col("x.t2").alias("p2"), "x.words", "x.run", (short & (F.col("x.pos") == F.col("got"))).alias("ends"),
    )
    above = F.lit(-1).cast("long")  # no node has this digest
    root = met.select(
        "conv", none.alias("depth"), none.alias("h1"), none.alias("h2"), above.alias("p1"), above.alias("p2"), none.alias("words"),
        none.alias("run"), (short & (F.col("got") == 0)).alias("ends"),
    )
    return stored(tail.mapInArrow(run, ROWS).union(early).union(root), "rebuilt")


# ---- node tables ------------------------------------------------------------


class Slots:
    """A minimal perfect hash of distinct 128-bit digests: bit levels, each for the keys that collided in those before.

    `find` gives the slot of a digest; the digest kept in the slot is compared,
    so one that isn't in the table gives -1.
    """

    def __init__(self, h1: np.ndarray, h2: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.h1, self.h2 = np.empty_like(h1), np.empty_like(h2)
        left, used = np.arange(len(h1)), 0
        while len(left):
            place = self._place(h1[left], h2[left], len(self.levels), size := max(8, 2 * len(left)))
            alone = np.bincount(place, minlength=size) == 1
            ranks = np.cumsum(alone) - alone + used
            self.levels.append((alone, ranks, size))
            ok = alone[place]
            self.h1[ranks[place[ok]]], self.h2[ranks[place[ok]]] = h1[left[ok]], h2[left[ok]]
            used += int(alone.sum())
            left = left[~ok]

    @staticmethod
    def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(h1 + mixed(h2 + np.uint64(2 * level + 1))) % np.uint64(size)).astype(np.int64)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (alone, ranks, size) in enumerate(self.levels):
            place = self._place(h1[left], h2[left], level, size)
            hit = alone[place]
            out[left[hit]] = ranks[place[hit]]
            left = left[~hit]
        ok = out >= 0
        ok[ok] = (self.h1[out[ok]] == h1[ok]) & (self.h2[out[ok]] == h2[ok])
        return np.where(ok, out, -1)


def summed_up(bottom: tuple, parent: tuple, depth: np.ndarray, own: np.ndarray, children: np.ndarray, leaves: np.ndarray, below: np.ndarray):
    """n_children, n_leaves and saved tokens below every chain, and whether its parent is in the table.

    own: saved tokens of the chain itself; children, leaves, below: what is already known to hang below it.
    """
    table = Slots(*bottom)
    slot = table.find(*bottom)
    n = len(slot)
    flat = {x: np.zeros(n, np.int64) for x in ("children", "leaves", "below", "own", "up")}
    for x, values in (("children", children), ("leaves", leaves), ("below", below), ("own", own), ("up", table.find(*parent))):
        flat[x][slot] = values
    deep = np.zeros(n, np.int64)
    deep[slot] = depth
    inner = flat["up"] >= 0
    np.add.at(flat["children"], flat["up"][inner], 1)
    flat["leaves"] += flat["children"] == 0  # a chain without children ends in a leaf
    order = np.argsort(-deep, kind="stable")
    order = order[inner[order]]
    cuts = np.flatnonzero(np.diff(deep[order])) + 1
    for level in np.split(order, cuts):
        up = flat["up"][level]
        np.add.at(flat["leaves"], up, flat["leaves"][level])
        np.add.at(flat["below"], up, flat["below"][level] + flat["own"][level])
    return flat["children"][slot], flat["leaves"][slot], flat["below"][slot], inner[slot]


CHAIN = "conv_id long, n_convs long, depth long, h1 long, h2 long, p1 long, p2 long, own long, children long, leaves long, below long"
DONE = "conv_id long, n_convs long, p1 long, p2 long, own long, children long, leaves long, below long, inner boolean"


def _shard(key: tuple, table: pa.Table) -> pa.Table:
    """The chains of one shard with their sums."""
    col = {x: table.column(x).to_numpy() for x in table.column_names}
    digest = lambda a, b: (np.ascontiguousarray(col[a]).view(np.uint64), np.ascontiguousarray(col[b]).view(np.uint64))
    children, leaves, below, inner = summed_up(
        digest("h1", "h2"), digest("p1", "p2"), col["depth"], col["own"], col["children"], col["leaves"], col["below"]
    )
    kept = [table.column(x) for x in ("conv_id", "n_convs", "p1", "p2", "own")]
    return pa.table([*kept, pa.array(children), pa.array(leaves), pa.array(below), pa.array(inner)], [x.split()[0] for x in DONE.split(", ")])


def _ends(rows: DataFrame) -> DataFrame:
    """depth, h1, h2, ends_sha256 of the nodes where conversations end: ids of one node go through tasks as joined texts."""
    order = [*NODE, "conv"]
    ends = rows.where("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in NODE])
            new = np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0)))
            begin = np.flatnonzero(new)
            at = np.arange(batch.num_rows) - np.repeat(begin, np.diff(np.append(begin, batch.num_rows)))
            first = np.flatnonzero(at % PIECE == 0)
            ids = pa.ListArray.from_arrays(pa.array(np.append(first, batch.num_rows).astype(np.int32)), batch.column("conv").cast(pa.string()))
            named = [batch.column(x).take(pa.array(first)) for x in order]
            yield pa.RecordBatch.from_arrays([*named, pc.binary_join(ids, ",")], [*order, "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *key, _, ids in zip(*(batch.column(x).to_pylist() for x in (*order, "ids"))):
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _named(done)
        if node is not None:
            yield _named([(*node, digest.hexdigest())])

    def _named(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done)) if done else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], [*NODE, "ends_sha256"])

    kinds = "depth long, h1 long, h2 long"
    parts = ends.mapInArrow(pieces, f"{kinds}, conv long, ids string")
    parts = parts.repartition(*NODE).sortWithinPartitions(*order)
    return parts.mapInArrow(hashed, f"{kinds}, ends_sha256 string")


def _chains(nodes: DataFrame) -> DataFrame:
    """One row for each run of nodes with one owner and one number of members."""
    top = F.min(F.struct("depth", "p1", "p2")).alias("top")
    bottom = F.max(F.struct("depth", "h1", "h2", "run")).alias("bottom")
    found = nodes.groupBy("conv_id", "n_convs").agg(top, bottom, F.sum("words").alias("words"))
    return found.select(
        "conv_id", "n_convs", F.col("top.depth").alias("top"), "top.p1", "top.p2", F.col("bottom.depth").alias("depth"), "bottom.h1", "bottom.h2",
        F.col("bottom.run").alias("run"), ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
    )


def _light_roots(rows: DataFrame, nodes: DataFrame, params: TrieParams) -> DataFrame:
    """conv_id, root_depth, shard_key: the first node on a conversation's path that isn't marked as one with many members."""
    key = F.xxhash64(*NODE)
    heavy = nodes.where(F.col("n_convs") > params.members).select(key.alias("key"))
    flags = bitmap(heavy, params.bits)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = ~marked(flags, batch.column("place").to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(keep)).select(["conv", "depth", "key"])

    shown = rows.select("conv", "depth", key.alias("key")).withColumn("place", place_of(F.col("key"), params.bits))
    first = shown.mapInArrow(light, "conv long, depth long, key long").groupBy("conv").agg(F.min(F.struct("depth", "key")).alias("x"))
    return first.select(F.col("conv").alias("conv_id"), F.col("x.depth").alias("root_depth"), F.col("x.key").alias("shard_key"))


def _tree(chains: DataFrame, rows: DataFrame, nodes: DataFrame, params: TrieParams) -> DataFrame:
    """conv_id, n_convs, children, leaves, below of the chains with two members and more."""
    # Chains of one conversation only count below their parent: it may have very many, so they are summed first.
    alone = chains.where("n_convs = 1").groupBy("p1", "p2").agg(F.count("*").alias("n"))
    shared = chains.where("n_convs > 1").join(
        alone.select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), F.col("n").alias("single")), ["h1", "h2"], "left"
    ).withColumn("single", F.coalesce("single", F.lit(0).cast("long")))
    placed = shared.join(_light_roots(rows, nodes, params), "conv_id", "left")
    start = placed.select(
        "conv_id", "n_convs", "depth", "h1", "h2", "p1", "p2", "own", F.col("single").alias("children"), F.col("single").alias("leaves"),
        F.lit(0).cast("long").alias("below"), (F.coalesce(F.col("root_depth") <= F.col("depth"), F.lit(False))).alias("light"), "shard_key",
    )
    start = stored(start, "chains")
    total = start.count()
    shards = 1 + total // params.members
    light = start.where("light").withColumn("shard", F.pmod("shard_key", F.lit(shards)))
    names = [x.split()[0] for x in CHAIN.split(", ")]
    done = stored(light.select(*names, "shard").groupBy("shard").applyInArrow(_shard, DONE), "shards")
    # The topmost chains of all shards, summed by the chain of the crown below which they hang.
    given = done.where("NOT inner").groupBy("p1", "p2").agg(
        F.count("*").alias("c"), F.sum("leaves").alias("l"), F.sum(F.col("below") + F.col("own")).alias("s")
    ).select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), "c", "l", "s")
    more = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0).cast("long"))).alias(x)
    crown = start.where("NOT light").join(given, ["h1", "h2"], "left").select(
        "conv_id", "n_convs", "depth", "h1", "h2", "p1", "p2", "own", more("children", "c"), more("leaves", "l"), more("below", "s"),
        F.lit(0).cast("long").alias("shard"),
    )
    top = crown.groupBy("shard").applyInArrow(_shard, DONE)
    return done.union(top).select("conv_id", "n_convs", "children", "leaves", "below")


def trie(turns: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """One row per node of the trie of rebuilt `turns` (conv_id, turn, role, text).

    Turns without a turn number come first; a null role or text is empty; turns
    of one number are ordered by the SHA-256 of `<length of role>:<role><text>`,
    and repeated rows are turns of their own. Rows without conv_id belong to no
    conversation. Other columns, whatever their names, are left out. An empty
    table gives no nodes, not even a root.
    """
    rows = rebuilt(turns.select("conv_id", "turn", "role", "text"), params)
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.first("words").alias("words"), F.first("run").alias("run"),
    )
    nodes = stored(nodes, "nodes")
    chains = stored(_chains(nodes), "chain_ends")
    # The root has no parent; all others' parents are nodes.
    parents = nodes.select((F.col("depth") + 1).alias("top"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("top_parent"))
    named = chains.join(parents, ["top", "p1", "p2"], "left").select(
        "conv_id", "n_convs", "top", F.col("depth").alias("bottom"), F.col("run").alias("bottom_run"), "top_parent"
    )
    sums = _tree(chains, rows, nodes, params)
    named = stored(named.join(sums, ["conv_id", "n_convs"], "left"), "chain_sums")
    inner = F.col("depth") < F.col("bottom")
    zero = F.lit(0).cast("long")
    out = nodes.join(named, ["conv_id", "n_convs"]).join(_ends(rows), NODE, "left")
    return out.select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == F.col("top"), F.col("top_parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(inner, F.lit(1).cast("long")).otherwise(F.coalesce("children", zero)).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.coalesce("below", zero) + (F.col("n_convs") - 1) * (F.col("bottom_run") - F.col("run") + F.col("words"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
