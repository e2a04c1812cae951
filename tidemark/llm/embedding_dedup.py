"""Near duplicates among embeddings of equal label, through a robust-pruned flat graph.

1. Equal vectors of a label are one node with a weight, so copies weigh nothing.
2. The nodes of a label are split, level by level, around centroids fitted on a bounded sample
   (SAMPLE nodes of a cell), until a cell holds at most LIMIT nodes. A node belongs to its nearest
   centroid's cell and to every other one whose border it is closer to than ``margin``: shards
   overlap, without a cap on how many a node may join. Cells that do not fall apart (a dense group)
   are dealt into blocks, and each pair of blocks is a shard.
3. Each shard builds its graph (``flat_graph.build``); the adjacency lists of a node are united over
   all its shards, and return to them.
4. In each shard every node searches its range from the medoid. A pair is counted in one shard, the
   smallest cell that both share. In each shard some nodes are compared with all others; where too
   few links were found, the shard is searched again with a wider beam.
5. Links are verified as they are found: cosines are computed in double precision. A shard returns
   a number per node and connecting links only, never all pairs of a group.
6. AUDITED nodes are compared with the whole table. While the recall is below TARGET_RECALL, all is
   done again with twice the margin.

The driver holds centroids of at most CENTROID_VALUES numbers at a time, the audited vectors and
their counts. Tasks hold shards of at most LIMIT nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import flat_graph
from tidemark.llm.components import components
from tidemark.session import discard, written

THRESHOLD = 0.93
LIMIT = 4096
TARGET = 2048
FAN_OUT = 64
SAMPLE = 4096
MARGIN = 0.06
ROUNDS = 3
DENSE = 0.9
AUDITED = 512
TARGET_RECALL = 0.95
SHARD_RECALL = 0.99
SHARD_AUDIT = 16
CENTROID_VALUES = 1 << 21

_SHARD = ("label", "d", "cell", "i", "j")
MOST_PARTITIONS = 20_000
_MEMBERS = "label string, d int, cell long, parent long, node long, w long, c array<double>"


def usable(c: Column) -> Column:
    """Whether a vector (array of doubles) can have a cosine: whole, finite, not zero, not empty."""
    return F.coalesce(
        (F.size(c) > 0) & F.exists(c, lambda v: v != 0)
        & ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))), F.lit(False)
    )


def _matrix(column) -> np.ndarray:
    """Unit rows of a list column whose lists have one length."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return flat_graph.unit(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _centroids(table):
    """Unit centroids of a cell's sample, by a few rounds of spherical k-means."""
    import pyarrow as pa

    table = table.sort_by("node")
    x, first = _matrix(table.column("c")), table.slice(0, 1).to_pylist()[0]
    k = min(FAN_OUT, max(2, -(-first["n"] // first["target"])), len(x))
    rng = np.random.default_rng(len(x))
    centres = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(6):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return pa.table({"cell": pa.array([first["cell"]], pa.int64()), "n": pa.array([first["n"]], pa.int64()),
                     "k": pa.array([k], pa.int32()), "centres": pa.array([centres.ravel().tolist()], pa.list_(pa.float64()))})


def _children(x: np.ndarray, centres: np.ndarray, margin: float) -> np.ndarray:
    """(vector, centroid) booleans: the nearest one, and those whose border is nearer than ``margin``."""
    sims = x @ centres.T
    home = sims.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))[home]
    return sims.max(axis=1, keepdims=True) - sims <= margin * apart


def _split(members: DataFrame, chosen: dict[int, tuple[int, np.ndarray]], margin: float) -> DataFrame:
    """Members with those of the chosen cells (cell -> size, centroids) moved to child cells."""
    shared = members.sparkSession.sparkContext.broadcast(chosen)
    names = [c.split()[0] for c in _MEMBERS.split(", ")]

    def move(parts: Iterator) -> Iterator:
        import pyarrow as pa

        from tidemark.llm.shingles import mixed

        for batch in parts:
            table = pa.Table.from_batches([batch]).select(names)
            cells = table.column("cell").to_numpy()
            for cell in np.unique(cells).tolist():
                rows = table.take(pa.array(np.flatnonzero(cells == cell)))
                if cell not in shared.value:
                    yield from rows.combine_chunks().to_batches()
                    continue
                size, centres = shared.value[cell]
                who, child = np.nonzero(_children(_matrix(rows.column("c")), centres, margin))
                made = rows.take(pa.array(who))
                ids = mixed((np.full(len(who), cell, dtype=np.int64).view(np.uint64) * np.uint64(31)) + (child + 1).astype(np.uint64))
                made = made.set_column(2, "cell", pa.array(ids.view(np.int64)))
                made = made.set_column(3, "parent", pa.array(np.full(len(who), size, dtype=np.int64)))
                yield from made.combine_chunks().to_batches()

    return members.mapInArrow(move, _MEMBERS)


def shards(nodes: DataFrame, margin: float = MARGIN, limit: int = LIMIT, target: int = TARGET) -> DataFrame:
    """Written members (label, d, cell, i, j, node, w, c): overlapping shards of at most ``limit`` nodes."""
    top = F.xxhash64("label", "d")
    members = written(
        nodes.select("label", "d", top.alias("cell"), F.lit(None).cast("long").alias("parent"), "node", "w", "c"), "members"
    )
    while True:
        sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("parent"), F.max("d").alias("d"))
        sizes = written(sizes.where(F.col("n") > limit), "cell-sizes")
        most = sizes.agg(F.max("d").alias("d")).first()["d"]
        if most is None:
            break
        large = sizes.where(f"parent IS NULL OR n < {DENSE} * parent").orderBy(F.desc("n"), "cell").limit(
            max(1, CENTROID_VALUES // (FAN_OUT * most))
        )
        picked = members.join(F.broadcast(large.select("cell", "n")), "cell")
        nth = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node", F.lit(7)), "node"))
        sample = picked.withColumn("nth", nth).where(F.col("nth") <= SAMPLE).select("cell", "n", F.lit(target).alias("target"), "node", "c")
        fitted = sample.groupBy("cell").applyInArrow(_centroids, "cell long, n long, k int, centres array<double>").collect()
        if not fitted:
            break
        chosen = {r["cell"]: (r["n"], np.array(r["centres"]).reshape(r["k"], -1)) for r in fitted}
        before, members = members, written(_split(members, chosen, margin), "members")
        discard(before, sizes)
    # What is still too large is dense: blocks of half the limit, in pairs.
    blocks = F.coalesce(F.ceil(F.col("n") / F.lit(limit // 2)), F.lit(1)).cast("int")
    dealt = members.join(sizes.select("cell", "n"), "cell", "left").select(
        "label", "d", "cell", "node", "w", "c", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("b"), blocks.alias("blocks")
    )
    out = written(
        dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
            "label", "d", "cell", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "node", "w", "c"
        ),
        "shards",
    )
    discard(members, sizes)
    return out


def _by_shard(members: DataFrame, number: int) -> DataFrame:
    """About one shard a task: shards are small in bytes and long in work, so partitions are not merged by size."""
    return members.repartition(max(1, min(number, MOST_PARTITIONS)), *_SHARD).groupBy(*_SHARD)


def adjacency(members: DataFrame, number: int) -> DataFrame:
    """(node, near): the neighbour lists of the shards' graphs, united."""

    def grow(table):
        import pyarrow as pa

        table = table.sort_by("node")
        names = table.column("node").to_numpy()
        near = flat_graph.build(_matrix(table.column("c")))
        return pa.table({"node": pa.array(names), "near": pa.array([names[r[r >= 0]] for r in near], pa.list_(pa.int64()))})

    grown = _by_shard(members, number).applyInArrow(grow, "node long, near array<long>")
    return grown.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _local(names: np.ndarray, lists) -> np.ndarray:
    """Neighbour lists of the shard's own nodes (``names`` sorted), as places, -1 where there are fewer."""
    import pyarrow as pa

    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists.fill_null([])
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    place = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    known = names[place] == flat
    owner, place = owner[known], place[known]
    count = np.bincount(owner, minlength=len(names))
    near = np.full((len(names), max(1, count.max(initial=0))), -1, dtype=np.int64)
    near[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)] = place
    return near


def _found(x: np.ndarray, near: np.ndarray, threshold: float) -> np.ndarray:
    """Linked pairs as a symmetric boolean matrix; the beam widens until audited nodes miss almost nothing."""
    n, start, beam = len(x), flat_graph.medoid(x), flat_graph.BEAM
    audited = np.unique(np.linspace(0, n - 1, min(n, SHARD_AUDIT)).astype(int))
    truth = x[audited] @ x.T >= threshold
    both = flat_graph.undirected(near)
    while True:
        out = np.concatenate([
            flat_graph.in_range(x, near, both, np.arange(a, min(a + flat_graph.BATCH, n)), start, threshold, beam)
            for a in range(0, n, flat_graph.BATCH)
        ])
        out |= out.T
        if (out[audited] & truth).sum() >= SHARD_RECALL * truth.sum() or beam >= n:
            np.fill_diagonal(out, False)
            return out
        beam *= 2


def _connecting(found: np.ndarray) -> list[tuple[int, int]]:
    """Links, fewer than there are nodes, that connect whatever ``found`` connects."""
    comp, links = np.arange(len(found)), []
    for q in np.flatnonzero(found.any(axis=1)).tolist():
        others = np.flatnonzero(found[q])
        roots, first = np.unique(comp[others], return_index=True)
        new = roots != comp[q]
        if new.any():
            links += [(q, int(v)) for v in others[first[new]]]
            comp[np.isin(comp, roots[new])] = comp[q]
    return links


def links(members: DataFrame, near: DataFrame, threshold: float, number: int) -> DataFrame:
    """Rows (a, b, n): the number of links of node ``a`` counted in a shard, or (with ``b``) a connecting link."""

    def search(table):
        import pyarrow as pa

        table = table.sort_by("node")
        names, w, blocks = (table.column(c).to_numpy() for c in ("node", "w", "b"))
        head = table.slice(0, 1).to_pylist()[0]
        x = _matrix(table.column("c"))
        found = _found(x, _local(names, table.column("near")), threshold)
        connecting = _connecting(found)
        if head["i"] != head["j"]:
            found &= blocks[:, None] != blocks[None, :]
        earlier = [[c for c in cells or [] if c < head["cell"]] for cells in table.column("cells").to_pylist()]
        for cell in {c for cells in earlier for c in cells}:  # pairs that share a smaller cell are counted there
            both = np.flatnonzero([cell in cells for cells in earlier])
            found[np.ix_(both, both)] = False
        n = np.concatenate([found[a : a + 1024] @ w for a in range(0, len(w), 1024)]) if len(w) else w
        own = np.flatnonzero(n > 0)
        a = [names[own], names[[p for p, _ in connecting]]] if connecting else [names[own]]
        b = [pa.nulls(len(own), pa.int64())] + ([pa.array(names[[q for _, q in connecting]])] if connecting else [])
        size = len(own) + len(connecting)
        return pa.table({
            "a": pa.array(np.concatenate(a)), "b": pa.chunked_array(b),
            "n": pa.array(np.concatenate([n[own], np.zeros(size - len(own), dtype=np.int64)])),
        })

    cells = members.groupBy("node").agg(F.collect_set("cell").alias("cells")).where(F.size("cells") > 1)
    listed = members.join(near, "node", "left").join(cells, "node", "left")
    return _by_shard(listed, number).applyInArrow(search, "a long, b long, n long")


def audited_recall(nodes: DataFrame, counts: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of the links of some nodes, compared with all rows, that ``counts`` (node, n) has; 1 if they have none."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(11)), "node").limit(audited).select("label", "d", "node", "w", "c").toPandas()
    if not len(sample):
        return 1.0
    groups = {
        key: (rows["node"].to_numpy(), flat_graph.unit(np.stack(rows["c"].to_list()).astype(float)))
        for key, rows in sample.groupby(["label", "d"], sort=True)
    }
    shared = nodes.sparkSession.sparkContext.broadcast(groups)

    def compare(parts: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, int] = {}
        for batch in parts:
            labels, sizes = batch.column("label").to_pylist(), batch.column("d").to_pylist()
            at: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(labels, sizes)):
                if key in shared.value:
                    at.setdefault(key, []).append(i)
            for key, rows in at.items():
                names, x = shared.value[key]
                some = batch.take(pa.array(rows))
                close = x @ _matrix(some.column("c")).T >= threshold
                close &= names[:, None] != some.column("node").to_numpy()[None, :]
                for name, n in zip(names.tolist(), (close @ some.column("w").to_numpy()).tolist()):
                    sums[name] = sums.get(name, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["node", "n"])

    truth = nodes.mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("truth"))
    both = truth.join(counts, "node", "left").agg(
        F.sum("truth").alias("truth"), F.sum(F.least(F.coalesce("n", F.lit(0)), "truth")).alias("n")
    ).first()
    return both["n"] / both["truth"] if both["truth"] else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT, target: int = TARGET) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) per row of ``vectors`` (vec_id, embedding, label).

    Vectors are compared if labels are equal and not null and lengths are equal. A vector that is
    null, empty or zero, or holds null or non-finite numbers, links with nothing. Equal vectors link
    with each other; a row that repeats is another vector with the same id. A null id is never the
    smallest of its component and is not kept; if all ids of a component are null, so is
    ``component_id``. ``recall`` is what the audit found. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("c"),
    )
    good = F.col("label").isNotNull() & usable(F.col("c"))
    named = rows.select("vec_id", "label", "c", F.when(good, F.xxhash64("label", "c")).alias("node"))
    nodes = written(
        named.where("node IS NOT NULL").groupBy("node", "label", "c").agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("first"))
        .withColumn("d", F.size("c")),
        "nodes",
    )
    for attempt in range(ROUNDS):
        members = shards(nodes, MARGIN * 2**attempt, limit, target)
        number = members.select(*_SHARD).distinct().count()
        near = written(adjacency(members, number), "adjacency")
        found = written(links(members, near, threshold, number), "links")
        counts = written(found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n")), "link-counts")
        discard(members, near)
        recall = audited_recall(nodes, counts, threshold)
        if recall >= TARGET_RECALL:
            break
    labels = components(found.where("b IS NOT NULL").select("a", "b"))
    parts = nodes.select("node", "first", "w").join(labels, "node", "left").withColumn("part", F.coalesce("label", "node"))
    smallest = parts.groupBy("part").agg(F.min("first").alias("component"))
    classes = written(
        parts.join(smallest, "part").join(counts, "node", "left")
        .select("node", "component", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")),
        "classes",
    )
    discard(found, counts, nodes)
    linked = named.select("vec_id", "node").join(classes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(float(recall)).alias("recall"),
    )
