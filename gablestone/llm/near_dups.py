"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, as 64-bit hashes; documents with one and the same
set become one node. A node's sketch is the K smallest hashes. The values that two sketches have
among the K smallest of both are binomial at worst, so that two sets with a similarity of at least s
have bound(s) values in common but for a chance of 1e-8 (sets below K are whole in their sketches).
Two linked nodes therefore meet in the inverted list of one of their K - bound + 1 rarest sketch
values (rarest by the number of nodes that hold a value, over all nodes; values that one node holds
need no list). Lists are kept by value and size band, as linked sets differ in size by 1.25 at most.

Lists of any length are worked through without all their pairs:

1. The leader of a list is the node whose sketch is shared most, such as the original of a group of
   copies. Each member meets its lists' leaders only. Where the sketches' union allows half the
   similarity, the full sets are compared: a deviation is what leader and member do not share.
2. What is similar to the leader leaves the list: of two linked nodes, one with a similarity of
   1 - 1.5 d (0.7 for links at d = 0.2) to the leader, the other has 1 - 2.5 d (0.5) by the triangle
   inequality, so that both have a deviation. Two nodes can be linked only if they share a large
   part of these, at least half of the smaller; so inverted lists of the first half of each deviation
   give all candidates, whatever order the leader's members agree on: values whose lists would make the
   fewest pairs come first. Members that are linked to the leader need no links among one another, and
   are tried one a list before all.
3. Members of half the similarity and more to one leader are decided by their deviations, so that a list of
   such members alone is done. Lists that are left have their next leaders, as long as a round at least
   halves them. What then remains is compared within its lists by sketches, but for pairs that a leader has
   decided.

Candidates of the last step are estimated from the union sketch and confirmed on the full sets; those
of the second are decided by deviations, which say the same as the sets.

Defined results: a null or empty text has an empty set and is linked with nothing; a text of fewer
words than a shingle has the sequence of all its words as its only shingle; rows that repeat a
doc_id are one document for links, and each row has its own n_shingles; a null doc_id has a null
component and is kept; other columns are not read. Sets are told apart by a 64-bit digest.
"""

from __future__ import annotations

from functools import cache, reduce
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import Work, texts, without

K = 64
MISSED = 1e-8
#: Bytes of text worked on at once.
SLICE = 2 << 20
#: Up to so many ids are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Words of the bit sets that bound what two deviations share.
BITS = 4


@cache
def bound(similarity: float) -> int:
    """The values among the K smallest of two sets' union that both have at least."""
    t, chance = 0, 0.0
    while True:
        chance += comb(K, t) * similarity**t * (1 - similarity) ** (K - t)
        if chance > MISSED:
            return t
        t += 1


def sets(column, width: int):
    """The sorted distinct shingle hashes of each text of an Arrow column, as int64."""
    from gablestone.llm import _words

    hashes, counts = _words.words(*_words.buffers(column), _words.DARK)
    at = 0
    for n in counts.tolist():
        h = hashes[at : at + n]
        at += n
        w = min(width, n)
        if not n:
            yield np.zeros(0, np.int64)
            continue
        key = np.full(n - w + 1, w, np.uint64)
        for j in range(w):
            key = _words.mix(key * np.uint64(0x9E3779B97F4A7C15) + h[j : n - w + 1 + j])
        yield np.unique(key.view(np.int64))


def _digest(s: np.ndarray) -> int | None:
    """The name of a set; none for the empty one."""
    from gablestone.llm._words import mix

    if not len(s):
        return None
    u = s.view(np.uint64)
    return int(mix(mix(u ^ np.uint64(len(s))).sum(keepdims=True) ^ u.sum(keepdims=True)).view(np.int64)[0])


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null for the empty one) and sketch."""

    def run(batches):
        import pyarrow as pa

        from gablestone.llm import _words

        for b in batches:
            for at, n in _words.slices(b.column("text"), SLICE):
                sizes, names, flat = [], [], []
                for s in sets(b.column("text").slice(at, n), width):
                    sizes.append(len(s))
                    names.append(_digest(s))
                    flat.append(s[:K])
                ends = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, n).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat)))],
                    names=["doc_id", "n_shingles", "digest", "sketch"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, n_shingles long, digest long, sketch array<long>")


def _lists(nodes: DataFrame, percent: int, work: Work) -> DataFrame:
    """(value, band, node, rank): the members of the inverted lists of each node's rarest sketch
    values, with how much of the sketch other nodes share."""
    rows = nodes.select("node", F.explode("sketch").alias("value"))
    # Each step's shuffle files go before the next step writes its own.
    held = work.cut(rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "held")
    work.release()
    # At most K rows a node: dealt out as they are, they are narrower than partial lists.
    shared = rows.join(held, "value").select("node", "df", "value").repartition("node")
    by_node = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"), F.sum(F.log("df")).alias("mass"))
    by_node = by_node.join(nodes.select("node", "n"), "node")
    size = F.least("n", F.lit(K))
    # Sketches of both are whole where the larger set can have K elements at most.
    need = F.expr(f"if(n * 100 <= {K * percent}, (n * {percent} + 99) div 100, {bound(percent / 100)})")
    # Values that no other node holds are the rarest.
    spare = (size - need + 1 - (size - F.size("values"))).cast("int")
    rank = (F.size("values") * 1000 / size).cast("int") * 100 + F.least(F.lit(99), (F.col("mass") / size * 4).cast("int"))
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    kept = by_node.withColumn("spare", spare).where("spare > 0").select("node", rank.alias("rank"), band.alias("own"), F.explode(F.slice("values", F.lit(1), F.col("spare"))).alias("v"))
    lists = kept.select(F.col("v.value").alias("value"), F.explode(F.array("own", F.col("own") + 1)).alias("band"), "node", "rank", "own")
    lists = work.cut(lists, "prefixes")
    work.drop("held")
    return lists


def _leaders(lists: DataFrame) -> DataFrame:
    """The lists of two members and more that are not all decided by one leader, with their leaders c."""
    top = lists.groupBy("value", "band").agg(F.max(F.struct("rank", "node")).alias("top"), F.count("*").alias("size"), F.bool_and("decided").alias("done")).where("size > 1 and not done")
    return lists.drop("decided").join(top.select("value", "band", F.col("top.node").alias("c")), ["value", "band"])


def _estimate(a: str, b: str, least: int):
    """Whether the union of two sketches of ints allows so many common values of K."""
    union = f"slice(sort_array(array_union({a}, {b})), 1, {K})"
    return F.expr(f"element_at(transform(array({union}), u -> size(filter(array_intersect({a}, {b}), x -> x <= element_at(u, -1))) * {K} >= {least} * size(u)), 1)")


def _sketch_of(nodes: DataFrame) -> DataFrame:
    """(node, n, s): sketches by the upper halves of their values, which keep the order."""
    return nodes.select("node", "n", F.transform("sketch", lambda x: F.shiftright(x, 32).cast("int")).alias("s"))


def _asked(pairs: DataFrame) -> DataFrame:
    """The nodes of pairs (c, x), to be broadcast where they are few."""
    nodes = pairs.select(F.col("c").alias("node")).union(pairs.select("x")).distinct()
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes


def _near(pairs: DataFrame, nodes: DataFrame, percent: float) -> DataFrame:
    """Of pairs (c, x) those that the sketches allow such a similarity."""
    own = _sketch_of(nodes.join(_asked(pairs), "node", "left_semi"))
    both = pairs.join(own.toDF("c", "n_c", "s_c"), "c").join(own.toDF("x", "n_x", "s_x"), "x")
    both = both.where(100 * F.least("n_c", "n_x") >= percent * F.greatest("n_c", "n_x"))
    return both.where(_estimate("s_c", "s_x", bound(percent / 100))).select("c", "x", "n_c", "n_x")


def _full_sets(asked: DataFrame, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, s): the sets of the nodes asked for, from one document of each."""
    named = nodes.join(asked, "node", "left_semi").select(F.col("first").alias("doc_id"), "node", F.col("digest").alias("wanted"))
    if named.count() <= BROADCAST_IDS:
        named = F.broadcast(named)

    def run(batches):
        import pyarrow as pa

        from gablestone.llm import _words

        for b in batches:
            for at, n in _words.slices(b.column("text"), SLICE):
                asked = zip(b.column("node").slice(at, n).to_pylist(), b.column("wanted").slice(at, n).to_pylist(), sets(b.column("text").slice(at, n), width), strict=True)
                own = [(x, s) for x, w, s in asked if _digest(s) == w]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in own], pa.int64()), pa.array([s for _, s in own], pa.list_(pa.int64()))], names=["node", "s"])

    # A doc_id may come with several texts; the node's own is the one that its digest says.
    return texts(docs).join(named, "doc_id").select("text", "node", "wanted").mapInArrow(run, "node long, s array<long>").dropDuplicates(["node"])


def _compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: float, work: Work, tag: str) -> DataFrame:
    """(c, x, n_c, n_x, linked, dev): pairs that the sketches allow, with what their full sets do not
    share: first what c lacks, then what x lacks."""
    pairs = work.cut(pairs, f"{tag}-pairs")
    work.release()
    whole = _full_sets(_asked(pairs), docs, nodes, width)
    # Both joins read one exchange of the sets.
    both = pairs.join(whole.toDF("c", "s_c"), "c").join(whole.toDF("x", "s_x"), "x")
    dev = F.concat(F.array_except("s_x", "s_c"), F.array_except("s_c", "s_x"))
    out = work.cut(both.select("c", "x", "n_c", "n_x", dev.alias("dev")).withColumn("linked", _links("size(dev)", "n_c + n_x", percent)), tag)
    work.drop(f"{tag}-pairs")
    del whole, both
    work.release()
    return out


def _links(apart: str, both: str, percent: float):
    """Whether sets of so many elements together, so many of them not shared, have the similarity."""
    return F.expr(f"({apart}) * cast({100 + percent} as bigint) <= ({both}) * cast({100 - percent} as bigint)")


def _by_deviation(met: DataFrame, percent: int, work: Work, tag: str) -> DataFrame:
    """Links (a, b) between members x of one leader c, one of them not linked with c."""
    p, q = 100 + percent, 100 - percent
    crowd = met.groupBy("c").agg(F.count("*").alias("k"), F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("out")).where("k > 1 and out > 0")
    word = lambda k: f"aggregate(dev, 0L, (a, v) -> if(shiftright(v, 6) & {BITS - 1} = {k}, a | shiftleft(1L, cast(v & 63 as int)), a))"
    met = met.join(crowd.select("c"), "c", "left_semi").withColumn("d", F.size("dev").cast("long"))
    # What a link with a member takes of both deviations; with a member that is not linked to c, and
    # with one that is.
    met = met.withColumn("short", F.expr(f"cast(d - (d * {p} + (n_c - n_x) * {q}) div {2 * p} as int)"))
    met = met.withColumn("long", F.expr(f"cast(d - greatest(1, ceil((d * {p} - (n_x + n_c) * {q}) / {2 * p}.0D)) + 1 as int)"))
    # A deviation's values come in the order of the pairs that their lists would make; those that make
    # none come first and need no list.
    values = met.select("c", "x", "linked", F.explode("dev").alias("v"))
    costs = values.groupBy("c", "v").agg((F.count_if(~F.col("linked")) * (F.count("*") - 1)).alias("cost")).where("cost > 0")
    costly = values.join(costs, ["c", "v"]).groupBy("c", "x").agg(F.sort_array(F.collect_list(F.struct("cost", "v"))).alias("values"))
    entry = met.withColumn("bits", F.expr(f"array({', '.join(map(word, range(BITS)))})")).drop("dev").join(costly, ["c", "x"])
    entry = entry.withColumn("free", F.col("d").cast("int") - F.size("values"))
    listed = "slice(values, 1, greatest(0, if(linked, short, greatest(short, long)) - free))"
    entry = entry.select("c", "x", "n_x", "d", "linked", "short", "free", "bits", F.posexplode(F.expr(listed)).alias("at", "v")).withColumn("at", F.col("at") + F.col("free"))
    entry = entry.select(F.xxhash64("c", "v.v").alias("key"), "c", "x", "n_x", "d", "linked", "at", (F.col("at") < F.col("short")).alias("early"), "bits")
    entry = work.cut(entry, f"{tag}-entries")
    work.release()
    columns = [c for c in entry.columns if c != "key"]
    ours = entry.where("not linked").select("key", *[F.col(c).alias(f"o_{c}") for c in columns])
    extra = lambda a, b: " + ".join(f"bit_count({a}bits[{k}] & ~{b}bits[{k}])" for k in range(BITS))
    # At most so many values are in both deviations, if this is the first of them in the order.
    shared = f"least(d - ({extra('', 'o_')}), o_d - ({extra('o_', '')}), d - at, o_d - o_at)"
    may = f"o_c = c and o_x <> x and {2 * p} * ({shared}) >= {p} * (d + o_d) - {q} * (n_x + o_n_x)"

    def confirmed(found: DataFrame, name: str) -> DataFrame:
        found = found.select("c", F.col("o_x").alias("a"), F.col("x").alias("b")).distinct()
        dev = met.select("c", "x", "n_x", "dev")
        both = found.join(dev.toDF("c", "a", "n_a", "d_a"), ["c", "a"]).join(dev.toDF("c", "b", "n_b", "d_b"), ["c", "b"])
        return work.cut(both.where(_links("size(d_a) + size(d_b) - 2 * size(array_intersect(d_a, d_b))", "n_a + n_b", percent)).select("c", "a", "b"), name)

    nearest = entry.where("linked").groupBy("key", "c").agg(F.min(F.struct("d", "x", "n_x", "at", "bits")).alias("m")).select("key", "c", "m.*")
    first = confirmed(ours.join(nearest, "key").where(may), f"{tag}-first")
    done = first.select(F.col("c").alias("o_c"), F.col("a").alias("o_x")).distinct()
    rest = ours.join(done, ["o_c", "o_x"], "left_anti")
    second = confirmed(rest.join(entry.where("linked"), "key").where(may), f"{tag}-second")
    third = confirmed(rest.where("o_early").join(entry.where("early and not linked"), "key").where(may), f"{tag}-third")
    return first.union(second).union(third).select("a", "b")


def _within_lists(lists: DataFrame, decided: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (c, x) of the members of a list that their sketches allow, each in one list only, without those
    of two members of one leader: decided has (c, node), the members of leaders c and these themselves."""
    prefix = lists.groupBy("node").agg(F.sort_array(F.collect_set("value")).alias("values"))
    led = decided.join(lists.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.collect_set("c").alias("led"))
    prefix = prefix.join(led, "node", "left").withColumn("led", F.coalesce("led", F.array().cast("array<bigint>")))
    rows = lists.select("value", "band", "node", "own").join(prefix, "node").join(_sketch_of(nodes), "node")
    ours = rows.select("value", "band", *[F.col(c).alias(f"{c}_c") for c in ("node", "own", "values", "led", "n", "s")])
    # A pair is looked at in the list of its smallest common value, in the band of the larger set.
    once = F.expr("node_c < node and band = greatest(own, own_c) and not arrays_overlap(led, led_c)") & (100 * F.least("n", "n_c") >= percent * F.greatest("n", "n_c")) & F.expr("array_min(array_intersect(values, values_c)) = value")
    met = ours.join(rows, ["value", "band"]).where(once & _estimate("s_c", "s", bound(percent / 100)))
    return met.select(F.col("node_c").alias("c"), F.col("node").alias("x"), "n_c", F.col("n").alias("n_x")).distinct()


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(v, c): the smallest vertex c that each vertex v of edges (a, b) reaches. Labels go to
    neighbours and jump to their labels' labels until nothing changes."""
    edges = work.cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels, k = work.cut(edges.select(F.col("a").alias("v")).distinct().withColumn("c", F.col("v")), "labels-0"), 0
    while True:
        near = edges.join(labels, edges["b"] == labels["v"]).groupBy(F.col("a").alias("v")).agg(F.min("c").alias("near"))
        step = work.cut(labels.join(near, "v", "left").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c")), f"step-{k}")
        jump = step.select(F.col("v").alias("_v"), F.col("c").alias("_c"))
        new = work.cut(step.join(jump, step["c"] == jump["_v"], "left").select("v", "old", F.least("c", "_c").alias("c")), f"labels-{k + 1}")
        work.drop(f"labels-{k}", f"step-{k}")
        labels, k = new.select("v", "c"), k + 1
        if new.where("c <> old").isEmpty():
            return labels


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    if not 80 <= percent < 100:
        raise ValueError("sketches are laid out for similarities of 0.8 and more")
    with Work(docs.sparkSession, "near-dups") as work:
        return work.keep(_groups(docs, width, percent, work))


def _groups(docs: DataFrame, width: int, percent: int, work: Work) -> DataFrame:
    away = 100 - percent
    rows = work.cut(sketches(docs, width), "rows")
    named = rows.where("digest is not null and doc_id is not null")
    nodes = named.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    # Nodes go by numbers, which take less room in shuffles; the written ones count.
    nodes = work.cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = work.cut(rows.select("doc_id", "n_shingles", "digest"), "ids")
    named = rows.where("digest is not null and doc_id is not null")
    work.drop("rows")
    work.release()
    prefixes = _lists(nodes, percent, work)
    work.release()
    lists = work.cut(_leaders(prefixes.withColumn("decided", F.lit(False))), "lists-0")
    work.drop("prefixes")
    work.release()
    links, led, k, size = [], [], 0, lists.count()
    while size:
        pairs = work.cut(lists.select("c", F.col("node").alias("x")).where("c <> x").distinct(), f"pairs-{k}")
        met = _compared(_near(pairs, nodes, 100 - 2.5 * away), docs, nodes, width, percent, work, f"met-{k}")
        links.append(met.where("linked").select(F.col("c").alias("a"), F.col("x").alias("b")))
        close = met.where(_links("size(dev)", "n_c + n_x", 100 - 2.5 * away))
        links.append(_by_deviation(close, percent, work, f"dev-{k}"))
        led += [close.select("c", F.col("x").alias("node")), close.select("c", F.col("c").alias("node")).distinct()]
        near = _links("size(dev)", "n_c + n_x", 100 - 1.5 * away)
        gone, half = close.where(near).select("c", F.col("x").alias("node")), close.where(~near).select("c", F.col("x").alias("node"), F.lit(True).alias("decided"))
        left = lists.where("node <> c").join(gone, ["c", "node"], "left_anti").join(half, ["c", "node"], "left").drop("c")
        lists = work.cut(_leaders(left.withColumn("decided", F.col("decided").isNotNull())), f"lists-{k + 1}")
        work.drop(f"lists-{k}")
        work.release()
        before, size, k = size, lists.count(), k + 1
        if size > before // 2:
            break
    if size:
        rest = _compared(_within_lists(lists, reduce(DataFrame.union, led), nodes, percent), docs, nodes, width, percent, work, "rest")
        links.append(rest.where("linked").select(F.col("c").alias("a"), F.col("x").alias("b")))
    # Documents of one doc_id and several sets hold their nodes together.
    several = named.groupBy("doc_id").agg(F.collect_set("digest").alias("all")).where("size(all) > 1").select("doc_id", F.explode("all").alias("digest"))
    several = several.join(nodes.select("digest", "node"), "digest").groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("all"))
    links.append(several.select("a", F.explode("all").alias("b")))
    edges = links[0]
    for more in links[1:]:
        edges = edges.union(more)
    labels = components(edges, work)
    lowest = nodes.join(labels, nodes["node"] == labels["v"]).groupBy("c").agg(F.min("first").alias("component_id"))
    lowest = labels.join(lowest, "c").select(F.col("v").alias("node"), "component_id")
    out = rows.join(nodes.select("digest", "node", "first"), "digest", "left").join(lowest, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "first", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that are near copies of another that stays, with their columns;
    of rows that repeat the doc_id that stays, all stay."""
    return without(docs, groups(docs, width, percent).where("not kept").select("doc_id"))
