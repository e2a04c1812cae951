"""From shared ids to components: candidate groups, verified in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, extended
from tidemark.llm.set_trie import join_group
from tidemark.session import discard, swept

BLOCK_IDS = 1 << 19
FEW = 64
SMALL_ROWS = 500_000
_NO_ID = -(1 << 63)


def linked(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Connecting links (a, b) inside each group of ``members`` (g1, g2, g3, key, label)."""

    def join(table):
        import pyarrow as pa

        keys = table.column("key").to_pylist()
        ids = table.column("ids").combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.chunk(0)
        flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        arrays = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        links = join_group(arrays, table.column("label").to_pylist(), num, den)
        return pa.table({
            "a": pa.array([keys[i] for i, _ in links], pa.int64()), "b": pa.array([keys[j] for _, j in links], pa.int64()),
        })

    return members.join(sets, "key").groupBy("g1", "g2", "g3").applyInArrow(join, "a long, b long")


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of at most SMALL_ROWS rows, so that what it meets stays where it is; larger ones are shuffled."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def _blocks(total):
    return F.greatest(F.lit(1), F.ceil(total / BLOCK_IDS)).cast("int")


def _likely_pairs(shared: DataFrame, ends: DataFrame | None, num: int, den: int) -> DataFrame:
    """(leader, key, n): pairs of the small groups whose shared tokens leave the threshold in reach.

    ``ends`` (key, w) has the last posted id of each set, of which the first ``p`` are posted. Of two sets, all
    common ids up to the smaller ``w`` are posted by both, so the overlap is at most the tokens they share here,
    plus what they may share in large groups, plus what the set with the smaller ``w`` has beyond its posted ids.
    """
    few = shared.where("NOT large").select("token", "key", "n")
    mine, theirs = few.alias("x"), few.alias("y")
    meets = (
        mine.join(theirs, (F.col("x.token") == F.col("y.token")) & (F.col("x.key") < F.col("y.key"))
                  & (den * F.least("x.n", "y.n") >= num * F.greatest("x.n", "y.n")))
        .groupBy(F.col("x.key").alias("leader"), F.col("y.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("c"), F.max("x.n").alias("nx"), F.max("y.n").alias("ny"))
    )
    if ends is None:
        return meets.select("leader", "key", F.col("ny").alias("n"))
    of = lambda t, name: ends.select(F.col("key").alias(name), F.col("w").alias(f"w{t}"), F.col("h").alias(f"h{t}"))
    meets = meets.join(of("x", "leader"), "leader").join(of("y", "key"), "key")
    beyond = lambda n: F.ceil(num * F.col(n) / F.lit(den)) - 1
    most = F.col("c") + F.least("hx", "hy") + F.when(F.col("wx") <= F.col("wy"), beyond("nx")).otherwise(beyond("ny"))
    return meets.where((num + den) * most >= num * (F.col("nx") + F.col("ny"))).select("leader", "key", F.col("ny").alias("n"))


def _stars(pairs: DataFrame) -> DataFrame:
    """Members (g1, g2, g3, key, label) of groups of bounded size, in which each leader meets the keys it is paired with.

    ``pairs`` (leader, key, n) are written. At most two rows come from each.
    """
    totals = pairs.groupBy("leader").agg(_blocks(F.sum("n")).alias("blocks"))
    dealt = pairs.join(totals, "leader").select(
        F.col("leader").alias("g1"), F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("g2"), "key"
    )
    leaders = totals.select(
        F.col("leader").alias("g1"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("g2"), F.col("leader").alias("key")
    )
    members = dealt.unionByName(leaders).select("g1", "g2", F.lit(0).alias("g3"), "key", F.col("key").alias("label"))
    return _if_small(members, 2 * pairs.count())


def resolve(
    docs: DataFrame, rows: DataFrame, postings: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int,
    prefixes: bool,
) -> DataFrame:
    """``rows`` (doc_id, n, key, others) as (doc_id, n_shingles, component_id, others), by their ``postings``.

    Two classes can only be linked if they share a token of ``postings`` (token, key, n: the size of the set). With
    ``prefixes``, the tokens are the first ``n - ceil(n * num / den) + 1`` ids of the sorted set. ``sets_of(docs)``
    gives (key, ids) with sorted ids of documents (doc_id, text, key) whose set has that key. Tokens of at most
    FEW rows give pairs, which are counted and cut by an upper bound of their overlap. Larger groups are
    joined around their smallest class. Each class meets the first of its leaders, then, where they are still in
    different components, the others; then, in pairs of blocks, classes of larger groups that still differ.
    """
    sizes = postings.groupBy("token").agg(
        F.min("key").alias("leader"), F.max("key").alias("other"), F.count(F.lit(1)).alias("k")
    ).where("leader < other")
    shared = swept(
        postings.join(sizes.select("token", "leader", (F.col("k") > FEW).alias("large")), "token")
        .groupBy("token", "leader", "large", "key").agg(F.max("n").alias("n")),
        "shared",
    )
    ends = None
    if prefixes:
        held = shared.groupBy("key").agg(F.sum(F.col("large").cast("long")).alias("h"))
        ends = swept(postings.groupBy("key").agg(F.max("token").alias("w")).join(held, "key"), "ends")
    pairs = swept(
        shared.where("large AND key <> leader").select("leader", "key", "n")
        .unionByName(_likely_pairs(shared, ends, num, den)).groupBy("leader", "key").agg(F.max("n").alias("n")),
        "pairs",
    )
    if ends is not None:
        discard(ends)
    names = pairs.select("key").unionByName(pairs.select(F.col("leader").alias("key"))).distinct()
    known = lambda c: F.coalesce(F.col(c), F.lit(_NO_ID))
    holders = swept(rows.join(names, "key").groupBy("key").agg(F.min(known("doc_id")).alias("_id")), "holders")
    held = docs.select("doc_id", "text").join(_if_small(holders, holders.count()), known("doc_id") == F.col("_id"))
    sets = swept(sets_of(held.select("doc_id", "text", "key")), "sets")
    tree = swept(pairs.groupBy("key").agg(F.min(F.struct("leader", "n")).alias("f")).select("f.leader", "key", "f.n"), "tree")
    tied = swept(linked(_stars(tree), sets, num, den), "near")
    parts = swept(components(tied), "parts")
    part = lambda c: parts.select(F.col("node").alias(c), F.col("label").alias(f"{c}_part"))
    apart = swept(
        pairs.join(tree, ["leader", "key"], "left_anti").join(part("leader"), "leader", "left").join(part("key"), "key", "left")
        .where(F.coalesce("leader_part", "leader") != F.coalesce("key_part", "key")).select("leader", "key", "n"),
        "apart",
    )
    crossed = swept(linked(_stars(apart), sets, num, den), "near")
    labels = extended(parts, crossed)
    discard(tree, tied, apart, crossed)

    marked = shared.where("large").join(labels, F.col("key") == F.col("node"), "left").select(
        "token", "key", "n", F.coalesce("label", "key").alias("label")
    )
    open_ids = (
        marked.groupBy("token")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("c"),
             F.bit_xor(F.xxhash64("key")).alias("x"), F.sum("n").alias("total"), F.min("key").alias("k"))
        .where("low < high")
        .groupBy("c", "x", "k", "total").agg(F.min("token").alias("token"))  # groups of the same classes are joined once
        .select("token", _blocks(F.col("total")).alias("blocks"))
    )
    placed = swept(
        marked.join(open_ids, "token").select(
            "token", "key", "label", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("i"), "blocks"
        ),
        "placed",
    )
    members = placed.agg(F.sum("blocks")).first()[0] or 0
    second = placed.select(
        "token", "key", "label", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j")
    ).select(
        F.col("token").alias("g1"), F.least("i", "j").alias("g2"), F.greatest("i", "j").alias("g3"), "key", "label"
    )
    final = labels
    if members:
        more = swept(linked(_if_small(second, members), sets, num, den), "near")
        final = extended(labels, more)
        discard(more)
    discard(shared, pairs, holders, sets, placed, *[t for t in (parts, labels) if t is not final])

    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = classes.join(final, classes["key"] == final["node"], "left").select(
        "key", "first", F.coalesce("label", "key").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_key = named.join(smallest, "label").select("key", "component_id")
    others = [c for c in rows.columns if c not in ("doc_id", "n", "key")]
    return rows.join(of_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), *others
    )
