"""Near-duplicates by bottom-k sketches of one hash function (operator 2).

1. Every text gives its set of word shingles, a digest of the set and the
   bottom-k sketch: the k least hashes. Equal sets are one class from here on,
   so copies cost one row each and are never paired.
2. Inverted lists of retained values generate overlaps. Two classes similar
   enough share at least `least_shared` retained values, so they meet in one
   of the rarest `size - least_shared + 1` values of each: a value that very
   many texts have (a shared passage) drops out without losing a pair, and a
   value of one class alone has no list.
3. Every class is compared, on the full sets, with one hub: the class of its
   lists whose retained values are the most common, or nearly so and with a
   smaller doc_id, as the original of a family of edited copies is. Where that
   leaves some of a family, the member nearest to the family's centre (the
   shingles that over half of it has) takes the hub's place, found and compared
   by the differences of step 4. This links most of a family with two pairs each.
4. What is left of a family is compared by differences from its hub. Let d(x) be
   what only one of x and the hub h has. x and y differ in what only one of d(x)
   and d(y) has, which for similar sets is at most the share a = (1-t)/(1+t) of
   |x| + |y|, t being the threshold; so differences and sizes give the exact
   answer. If neither x nor y is linked to the hub, |d(x)| and |d(y)| exceed that
   share with h, so they share about half of their differences. Inverted lists of
   the rarest differences (all but those that must be shared, and one more) elect
   a class each, the one nearest to the hub, and members are compared with it, as
   long as that finds links.
   Let c be the core of a family: the hub's shingles and those that many of the
   family share, and x' the shingles of x that c lacks. Classes x and y that are
   then still in different components are similar only if x' and y' meet or the
   smaller of |x & c| and |y & c| is at least t/(1+t) * (|x| + |y|), for nothing
   else can be in both. Lists of x', short as c has what is common, and a join on
   sizes give these pairs. Where very many of a family stay apart, with the same
   few edits in many of them, the second kind is not linear in the family.
5. Only classes of one list with different hubs are paired directly. The sketch
   of the union estimates their similarity; pairs far below the threshold go. The
   rest are confirmed by the exact Jaccard similarity of the full sets. No list
   or group has a cap.

The chance that a pair at the threshold shares fewer than `least_shared` values
or is estimated below the cut is that of a binomial six deviations off (about
1e-8); sets of up to k shingles are treated exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.tables import bitmap, components, dropped, empty, marked, place_of, stored, working_tables
from gavel.llm.words import Words, fold_ascii, mixed, rolling, slices, texts_of, tidied

LEAST_COMMON, COMMON = 8, 32  # a family's core has what more than 8 members and one in 32 share
HOT_SHARE = 64  # a value that more than one class in 64 retains: at most k * 64 of them, whatever the corpus
MEMBERS = 512  # members of a family that meet a copy of their hub's set in one place, about
FILTER_BITS = 26  # the bitmap of texts whose sets are needed: 8 MB, whatever the corpus


@dataclass(frozen=True)
class NearParams:
    words: int = 4  # words a shingle
    percent: int = 80  # least similarity, in percent
    k: int = 64  # retained values

    @property
    def least_shared(self) -> int:
        """Retained values that two sketches of similar sets share, six deviations below the mean."""
        p = self.percent / 100
        return max(1, math.floor(self.k * p - 6 * math.sqrt(self.k * p * (1 - p))))

    @property
    def least_estimate(self) -> float:
        return self.least_shared / self.k


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (63 bits) of every text; the whole text if it has under n words, empty without words."""
    words = Words(fold_ascii(texts))
    h = mixed(words.hashes())
    grams = mixed(rolling(h, n)) >> np.uint64(1)
    out = []
    for a, b in zip(words.start[:-1], words.start[1:]):
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))].astype(np.int64))
        elif b > a:
            short = mixed(rolling(h[a:b], int(b - a)) + np.uint64(b - a)) >> np.uint64(1)
            out.append(short.astype(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _digest(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def sketches(docs: DataFrame, params: NearParams) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set, null if empty), sketch."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(texts_of(part), params.words)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([_digest(x) for x in sets], pa.binary()), _lists([x[: params.k] for x in sets])],
                ["doc_id", "n_shingles", "node", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, node binary, sketch array<long>")


def _postings(classes: DataFrame, params: NearParams) -> DataFrame:
    """value, node, common: the rarest retained values of each class that other classes have too, as many as could miss.

    common is how often the class's retained values occur, all together.
    """
    entries = classes.select("node", "n_shingles", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = stored(entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    # Common values are few (the bound is proven: k * HOT_SHARE rows), so their many rows needn't meet in one place.
    common = shared.where(F.col("df") * HOT_SHARE > classes.count())
    hot = entries.join(F.broadcast(common), "value")
    cold = entries.join(F.broadcast(common.select("value")), "value", "left_anti").join(shared, "value")
    # Sets below this size have partners whose sketch is the whole set, too.
    whole = math.floor(params.k * params.percent / 100)
    least = F.when(
        F.col("n_shingles") <= whole, F.ceil(F.col("n_shingles") * params.percent / 100)
    ).otherwise(F.lit(params.least_shared))
    by_node = (
        cold.union(hot)
        .groupBy("node", "n_shingles", "size")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found"), F.sum("df").alias("common"))  # k entries at most
    )
    room = (F.col("size") - least + 1) - (F.col("size") - F.size("found"))  # values of one class come first
    return by_node.where(room > 0).select(
        "node", "common", F.explode(F.slice("found", 1, room.cast("int"))).alias("x")
    ).select(F.col("x.value").alias("value"), "node", "common")


def _hubs(met: DataFrame, classes: DataFrame) -> DataFrame:
    """node, hub. Which class is a family's hub decides how many pairs are left to test, not the result."""
    own = met.groupBy("node").agg(F.first("common").alias("common"), F.max("top").alias("top"))
    own = own.join(classes.select("node", "doc_id"), "node").select(
        "node", "doc_id", "common", F.col("top.common").alias("most"), F.col("top.node").alias("hub")
    )
    # Of those with nearly as common values the first document: copies follow their original.
    lead = own.where(F.col("common") * 10 >= F.col("most") * 9).groupBy("hub").agg(F.min(F.struct("doc_id", "node")).alias("lead"))
    return own.join(lead, "hub", "left").select("node", F.coalesce("lead.node", "hub").alias("hub"))


def _pairs(left: DataFrame) -> DataFrame:
    """Distinct unordered pairs of the columns node, other."""
    return (
        left.where("node <> other")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _estimated(pairs: DataFrame, sketch: DataFrame, params: NearParams) -> DataFrame:
    """Pairs whose union sketch doesn't rule them out."""
    side = lambda x: sketch.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
    joined = pairs.join(side("a"), "a").where(F.col("na") > 0).join(side("b"), "b")
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * params.percent
    joined = joined.where(near)
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, params.k)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    full = (F.col("na") <= params.k) & (F.col("nb") <= params.k)
    exact = F.size(F.array_intersect("sa", "sb")) * 100 >= F.size(F.array_union("sa", "sb")) * params.percent
    return joined.where(F.when(full, exact).otherwise(both >= params.least_estimate * F.size(union))).select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame, params: NearParams) -> DataFrame:
    """node, items: the full sets of the classes named in `nodes` (node, doc_id of one text).

    A bitmap of bounded size keeps nearly all other texts from being split; a
    join on the digest makes the choice exact.
    """
    flags = bitmap(nodes.select("doc_id"), FILTER_BITS)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = marked(flags, batch.column("place").to_numpy(zero_copy_only=False))
            for part in slices([batch.filter(pa.array(own))]):
                sets = shingle_sets(texts_of(part), params.words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([_digest(x) for x in sets], pa.binary()), _lists(sets)],
                    ["doc_id", "node", "items"],
                )

    found = docs.select("doc_id", "text", place_of(F.col("doc_id"), FILTER_BITS).alias("place")).mapInArrow(
        run, "doc_id long, node binary, items array<long>"
    )
    # Null ids and repeated ids with other texts can't bring a wrong set: the digest is part of the key.
    wanted = nodes.select(F.col("node").alias("own"), F.col("doc_id").alias("own_id"))
    rows = found.join(wanted, F.col("own").eqNullSafe(F.col("node")) & F.col("own_id").eqNullSafe(F.col("doc_id")))
    return rows.select("node", "items")


def _confirmed(pairs: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    # The greater of a pair brings its set to the lesser one, which many pairs may share.
    side = lambda x: sets.select(F.col("node").alias(x), F.col("items").alias(f"i{x}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("ia", "ib"))
    return met.where(common * 100 >= (F.size("ia") + F.size("ib") - common) * params.percent).select("a", "b")


def _classes(docs: DataFrame, params: NearParams) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles, node of every row, and node, class_id (the least doc_id of its component) of every class, stored."""
    rows = stored(sketches(docs, params), "sketches")
    classes = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    lists = stored(_postings(classes, params), "postings")
    top = lists.groupBy("value").agg(F.max(F.struct("common", "node")).alias("top"), F.count("*").alias("n")).where("n > 1")
    met = lists.join(top, "value")
    hubs = stored(_hubs(met, classes), "hubs")
    size = hubs.count()
    labels = None
    if size:
        sets = stored(_sets(docs, classes.select("node", "doc_id").join(hubs.select("node"), "node"), params), "sets")
        # A large family is one with more members than meet their hub's set in one place.
        large = hubs.groupBy("hub").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts")).where("parts > 1")
        large = stored(large, "large_families", size // MEMBERS)
        family = stored(_against_hub(hubs, sets, large, params), "family")
        to_hub = lambda x: x.where("linked AND node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
        links = to_hub(family)
        if (centred := _centred(family, large, params)) is not None:
            links = links.union(to_hub(centred)).distinct()
            first, kept = family, family.join(centred.select(F.col("old_hub").alias("hub")).distinct(), "hub", "left_anti")
            family = stored(kept.unionByName(centred.drop("old_hub")), "families")
        links = stored(links, "hub_links")
        if centred is not None:
            dropped(first)
            dropped(centred)
        if not empty(links):
            labels = components(links)
        links, labels = _by_differences(family, links, labels, size, params)
        dropped(family)
        pairs = _other_hub(_labelled(lists.select("value", "node").join(hubs, "node"), labels))
        pairs = stored(_estimated(pairs, classes.select("node", "sketch", "n_shingles"), params), "pairs")
        if not empty(pairs):
            more = stored(_confirmed(pairs, sets, params), "links")
            if not empty(more):
                labels = components(links.union(more))
    own = classes.select("node", F.col("doc_id").alias("class_id"))
    if labels is not None:
        named = labels.join(own, "node")
        least = named.groupBy("label").agg(F.min("class_id").alias("component_id"))
        own = own.join(named.join(least, "label").select("node", "component_id"), "node", "left").select(
            "node", F.coalesce("component_id", "class_id").alias("class_id")
        )
    # A table of its own, so that adaptive execution can split a class that very many rows have.
    own = stored(own, "components")
    return rows, own


def near_duplicates(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, kept tells the
    row that has it. A null or empty text has no shingles, is linked with
    nothing and is kept. Rows that repeat a doc_id and text count as one
    document and are kept or dropped together; a row without doc_id is kept
    only if its whole component has none. An empty table gives an empty result.
    """
    keep: list[DataFrame] = []
    with working_tables(keep):
        rows, own = _classes(docs, params)
        keep += [rows, own]
    out = rows.select("doc_id", "n_shingles", "node").join(own, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _labelled(nodes: DataFrame, labels: DataFrame | None, name: str = "node", label: str = "label") -> DataFrame:
    """`nodes` with the component of column `name`: the node itself while it has no link."""
    if labels is None:
        return nodes.withColumn(label, F.col(name))
    found = labels.select(F.col("node").alias(name), F.col("label").alias("__label"))
    return nodes.join(found, name, "left").withColumn(label, F.coalesce("__label", name)).drop("__label")


def _beside(members: DataFrame, sides: DataFrame, large: DataFrame) -> DataFrame:
    """`members` (node, hub, ...) with the row of `sides` (hub, ...) of their family."""
    # A large family is spread over copies of its row, one for every MEMBERS members.
    parts = F.coalesce("parts", F.lit(1))
    own = members.join(large, "hub", "left").withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).drop("parts")
    spread = sides.join(large, "hub", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return own.join(spread, ["hub", "part"]).drop("part")


def _judged(met: DataFrame, params: NearParams) -> DataFrame:
    """`met` (node, hub, n, hub_n, rest, diff) with d, shared and linked."""
    t = params.percent
    met = met.withColumn("d", F.size("diff")).withColumn("shared", F.col("n") - F.size("rest"))
    return met.withColumn("linked", F.col("d") * (100 + t) <= (F.col("n") + F.col("hub_n")) * (100 - t))


def _against_hub(hubs: DataFrame, sets: DataFrame, large: DataFrame, params: NearParams) -> DataFrame:
    """node, hub, n, hub_n, shared, rest (what the hub lacks), diff (what only one of both has), d (its size), linked, from the full sets."""
    hub_sets = sets.join(hubs.select("hub").distinct().withColumnRenamed("hub", "node"), "node", "left_semi").select(
        F.col("node").alias("hub"), F.col("items").alias("hub_items")
    )
    met = _beside(hubs.join(sets, "node"), hub_sets, large).withColumn("rest", F.array_except("items", "hub_items"))
    diff = F.concat("rest", F.array_except("hub_items", "items"))
    met = met.select("node", "hub", F.size("items").alias("n"), F.size("hub_items").alias("hub_n"), "rest", diff.alias("diff"))
    return _judged(met, params)


def _centred(family: DataFrame, large: DataFrame, params: NearParams) -> DataFrame | None:
    """The families with more than LEAST_COMMON members and not all of them linked, their hub replaced by the member
    nearest to their centre: `family` with old_hub. None if there is no such family.

    The centre is the set of the shingles that over half of the family has. It differs from the hub in the differences
    that over half of the members have, so all of this is counted on the differences, and the new ones follow from them.
    """
    open_ones = family.groupBy("hub").agg(F.count("*").alias("members"), F.min("linked").alias("all"))
    open_ones = stored(open_ones.where((F.col("members") > LEAST_COMMON) & ~F.col("all")).drop("all"), "open_families")
    if empty(open_ones):
        return None
    own = family.join(open_ones, "hub", "left_semi")
    counts = own.select("hub", F.explode("diff").alias("item")).groupBy("hub", "item").agg(F.count("*").alias("n"))
    # Differences that half of the members have are at most twice as many as a member has on average.
    turned = counts.where(F.col("n") * 2 > LEAST_COMMON).join(open_ones, "hub").where("n * 2 > members")
    turned = turned.groupBy("hub").agg(F.collect_list("item").alias("turned"))
    none = F.array().cast("array<long>")
    centres = stored(open_ones.join(turned, "hub", "left").select("hub", F.coalesce("turned", none).alias("turned")), "centres")
    away = F.col("d") + F.size("turned") - 2 * F.size(F.array_intersect("diff", "turned"))
    nearest = _beside(family.select("node", "hub", "d", "diff"), centres, large).groupBy("hub").agg(
        F.min(F.struct(away.alias("away"), "node")).alias("least")
    )
    leads = stored(
        family.join(nearest.select("hub", F.col("least.node").alias("node")), ["hub", "node"]).select(
            "hub", F.col("node").alias("lead"), F.col("n").alias("lead_n"), F.col("diff").alias("lead_diff"),
            F.array_except("diff", "rest").alias("lead_lacks"),
        ),
        "leads",
    )
    # x has what the lead lacks: of what the hub lacks, what the lead doesn't have either, and of the hub's what only the lead lacks.
    rest = F.concat(F.array_except("rest", "lead_diff"), F.array_except("lead_lacks", "diff"))
    diff = F.concat(F.array_except("diff", "lead_diff"), F.array_except("lead_diff", "diff"))
    met = _beside(family.select("node", "hub", "n", "rest", "diff"), leads, large).select(
        "node", F.col("hub").alias("old_hub"), F.col("lead").alias("hub"), "n", F.col("lead_n").alias("hub_n"), rest.alias("rest"), diff.alias("diff")
    )
    return stored(_judged(met, params), "centred")


def _difference_lists(family: DataFrame, params: NearParams) -> DataFrame:
    """hub, item, node, n, d, common: entries of inverted lists of the differences of classes that their hub doesn't link."""
    t = params.percent
    some = family.where("NOT linked")
    entries = some.select("node", "hub", F.explode("diff").alias("item"))
    shared = stored(entries.groupBy("hub", "item").agg(F.count("*").alias("df")).where("df > 1"), "shared_differences")
    # A list is as long as the differences of one class at most.
    ranked = entries.join(shared, ["hub", "item"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "item"))).alias("found"), F.sum("df").alias("common")
    )
    ranked = ranked.join(some.select("node", "hub", "n", "hub_n", "d"), "node")
    alone = F.col("d") - F.size("found")  # differences of one class come first
    least = F.floor((F.col("d") * (100 + t) + (F.col("hub_n") - F.col("n")) * (100 - t)) / (2 * (100 + t)) - 1e-9) + 1
    length = (F.col("d") - least + 1 - alone).cast("int")
    return ranked.withColumn("length", length).where("length > 0").select(
        "node", "hub", "n", "d", "common", F.explode(F.slice("found", 1, F.col("length"))).alias("x")
    ).select("hub", F.col("x.item").alias("item"), "node", "n", "d", "common")


def _by_differences(family: DataFrame, links: DataFrame, labels: DataFrame | None, size: int, params: NearParams) -> tuple[DataFrame, DataFrame | None]:
    """All links and components after those of one family have been added."""
    t = params.percent
    if empty(family.where("NOT linked")):
        return links, labels
    lists = stored(_difference_lists(family, params), "difference_lists")
    # What the two can share at most has to reach what similar sets of their sizes share.
    fits = (F.least("d", "other_d") * 2 - F.col("d") - F.col("other_d")) * (100 + t) + (F.col("n") + F.col("other_n")) * (100 - t) >= 0
    close = F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * t
    side = family.select("node", "n", "d", "diff")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("d").alias("da"), F.col("diff").alias("ia"))
        b = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("d").alias("db"), F.col("diff").alias("ib"))
        apart = F.col("da") + F.col("db") - 2 * F.size(F.array_intersect("ia", "ib"))
        met = pairs.join(b, "b").join(a, "a").where(apart * (100 + t) <= (F.col("na") + F.col("nb")) * (100 - t))
        return stored(met.select("a", "b"), "difference_links")

    while True:
        named = stored(_labelled(lists, labels), "named_lists")
        # Each list elects the class nearest to the hub: of those with the same edits it has the fewest others.
        top = named.groupBy("hub", "item").agg(
            F.min(F.struct("d", "node", "label", "n")).alias("top"), F.count("*").alias("size")
        ).where("size > 1")
        met = named.join(top, ["hub", "item"]).select(
            "node", "n", "d", "label", F.col("top.node").alias("other"), F.col("top.label").alias("other_label"),
            F.col("top.n").alias("other_n"), F.col("top.d").alias("other_d"),
        )
        new = confirmed(_pairs(met.where((F.col("label") != F.col("other_label")) & fits & close)))
        if empty(new):
            break
        links = stored(links.union(new), "links")
        labels = components(links)
    some = _labelled(family.select("node", "hub", "n", "shared", "rest"), labels)
    named, pairs = _same_rest(stored(some.drop("rest"), "named", size), some.select("node", F.explode("rest").alias("item")), size)
    new = confirmed(pairs.union(_within_hub(named, params)).distinct())
    if not empty(new):
        links = stored(links.union(new), "links")
        labels = components(links)
    return links, labels


def _same_rest(named: DataFrame, rests: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """`named` with what each class shares with its family's core, and the pairs of one family and different
    components that share a shingle outside of it."""
    entries = rests.join(named.select("node", "hub", "label"), "node")
    counts = entries.groupBy("hub", "item").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    counts = stored(counts.where("n > 1"), "rest_counts")
    families = named.groupBy("hub").agg(F.count("*").alias("members"))
    common = F.col("n") > F.greatest(F.lit(LEAST_COMMON), F.col("members") / COMMON)
    counts = counts.join(families, "hub").select("hub", "item", common.alias("core"), (F.col("low") != F.col("high")).alias("open"))
    found = stored(entries.join(counts.where("core OR open"), ["hub", "item"]), "rests")
    more = found.where("core").groupBy("node").agg(F.count("*").alias("more"))
    named = named.join(more, "node", "left").withColumn("shared", F.col("shared") + F.coalesce("more", F.lit(0))).drop("more")
    found = found.where("open AND NOT core").select("hub", "item", "node", "label")
    other = found.select("hub", "item", F.col("node").alias("other"), F.col("label").alias("other_label"))
    pairs = _pairs(found.join(other, ["hub", "item"]).where("label <> other_label AND node < other"))
    return stored(named, "named", size), pairs


def _within_hub(named: DataFrame, params: NearParams) -> DataFrame:
    """Pairs of one hub and different components that could be similar by what they share with the hub alone."""
    # With t the threshold: the smaller of both `shared` is at least t/(1+t) * (n + other n).
    # So a partner has at most `most` shingles, and both ways.
    t = params.percent
    reach = named.select(
        "hub", "node", "label", "n", F.floor(F.col("shared") * (100 + t) / t + 1e-9).cast("int").alias("sum")
    ).withColumn("most", F.col("sum") - F.col("n")).where(F.col("most") * 100 >= F.col("n") * t)
    sizes = reach.select("hub", F.col("n").alias("other_n")).distinct()
    fitting = reach.join(sizes, "hub").where((F.col("other_n") <= F.col("most")) & (F.col("other_n") * 100 >= F.col("n") * t))
    other = reach.select(
        "hub", F.col("n").alias("other_n"), F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("most").alias("other_most")
    )
    return _pairs(fitting.join(other, ["hub", "other_n"]).where("label <> other_label AND n <= other_most AND node <> other"))


def _other_hub(listed: DataFrame) -> DataFrame:
    """Pairs of one list that have different hubs and components: classes outside the list's largest hub meet all others."""
    sizes = listed.groupBy("value", "hub").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("value").agg(F.max(F.struct("n", "hub")).alias("top"), F.count("*").alias("kinds"))
    open_lists = stored(
        listed.join(largest.where("kinds > 1").select("value", F.col("top.hub").alias("top")), "value"), "open_lists"
    )
    minor = open_lists.where("hub <> top").select(
        "value", F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("hub").alias("other_hub")
    )
    return _pairs(open_lists.join(minor, "value").where("label <> other_label AND hub <> other_hub").select("node", "other"))
