"""Embedding near-duplicates by a robust-pruned flat graph (operator 3).

Vectors of one label are dealt to the clusters they lie nearest to, and to all others nearly as
near, so shards overlap. Each shard builds a graph: from each vector to its close vectors,
pruned so that no kept neighbour is nearer to another kept one than to the vector by the factor
``ALPHA``. The adjacency lists of a vector from all its shards are united. Then each vector
searches its shards: greedily from the shard's medoids, and from there through every vector in
an extended range around it. Links are verified by cosines in double precision. A sample of
vectors is compared with every row of its label, for every table; if too few of their links were
found, all is done again with more overlap, and at last by comparing block with block.

Where a vector's pool of nearest vectors ends within the extended range, many near copies crowd
it and no edge may lead out. Such vectors are covered with balls: each has an edge to and from the
medoid of its ball, and a query starts at every such medoid in its range too. The balls are so small
that the medoid of a vector that links with the query lies in that range, so none is missed.

Equal vectors count as one with a multiplicity. A link is counted in the first shard that holds
both its ends, and only a spanning forest of the links leaves a task, so a large group of near
copies gives no pairs. A cluster that outgrows a task is split by a hash into blocks; every
block of queries then meets every block's graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage
from tradewind.llm.components import components
from tradewind.llm.vectors import matrix, sound

SHARD, BLOCK = 2048, 4096
CENTROIDS, FIT_ON = 1024, 20_000
POOL, DEGREE, ALPHA = 48, 20, 1.2
BEAM, STARTS, EXTENDED = 16, 8, 0.08
# Cosines this much below the best still make a vector a member of a cluster.
MARGINS = (0.12, 0.3, 2.0)
AUDITED, RECALL = 512, 0.97


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def ball(least: float) -> float:
    """Cosine to a ball's centre at which the ball of a link's one end lies in the other's range."""
    return float(np.cos(np.arccos(least - EXTENDED) - np.arccos(least))) + 1e-9


def _cover(x: np.ndarray, crowded: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(centre, member) of balls that hold all ``crowded`` vectors; a centre is in its own ball."""
    centres, members, left = [], [], crowded
    while len(left):
        inside = x[left] @ x[left[0]] >= ball(least)
        inside[0] = True
        members.append(left[inside])
        centres.append(np.full(len(members[-1]), left[0]))
        left = left[~inside]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *centres]), np.concatenate([none, *members])


def pruned_graph(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (from, to) among unit vectors, robust-pruned, with their reverses; and the medoids of
    the balls of crowded vectors, which have edges to all of their ball."""
    n = len(x)
    pool, step = min(POOL, n - 1), 256
    out, crowded = [], []
    for s in range(0, n, step) if pool > 0 else ():
        own = np.arange(s, min(n, s + step))
        near = x[own] @ x.T
        near[np.arange(len(own)), own] = -np.inf
        some = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
        some = np.take_along_axis(some, order, axis=1)
        far = 1 - np.take_along_axis(near, some, axis=1)
        if pool < n - 1:
            crowded.append(own[far[:, -1] <= 1 - least + EXTENDED])
        between = 1 - np.einsum("npd,nqd->npq", x[some], x[some])
        alive = np.ones(some.shape, dtype=bool)
        rows = np.arange(len(own))
        for _ in range(DEGREE):
            has = alive.any(axis=1)
            if not has.any():
                break
            pick = alive.argmax(axis=1)
            out.append(np.stack([own[has], some[rows, pick][has]]))
            # Squared distances of unit vectors are twice 1 - cosine.
            alive &= ALPHA**2 * between[rows, pick] > far
            alive[rows, pick] = False
    centre, member = _cover(x, np.concatenate([np.zeros(0, np.int64), *crowded]), least)
    edges = np.concatenate([*out, np.stack([centre, member])[:, centre != member]], axis=1)
    code = np.unique(np.concatenate([edges[0] * n + edges[1], edges[1] * n + edges[0]]))
    return code // n, code % n, np.unique(centre)


def medoids(x: np.ndarray) -> np.ndarray:
    """The vector nearest the mean, then those farthest from all chosen before."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    reach = x @ x[chosen[0]]
    while len(chosen) < min(STARTS, len(x)):
        chosen.append(int(reach.argmin()))
        reach = np.maximum(reach, x @ x[chosen[-1]])
    return np.array(chosen)


def range_search(
    x: np.ndarray, at: np.ndarray, to: np.ndarray, leads: np.ndarray, q: np.ndarray, own: np.ndarray, least: float
):
    """Pairs (query, node) with cosine >= ``least`` found in the graph (rows ``at`` of ``to``).

    Greedy from the medoids, from those of balls (``leads``) in the extended range, and from the
    query's own node where ``own`` is not negative, then through all nodes with cosine >= ``least`` - EXTENDED.
    """
    n, low = len(x), least - EXTENDED
    start = medoids(x)
    queries, nodes = [], []
    for s in range(0, len(q), 256):
        y, mine = q[s : s + 256], own[s : s + 256]
        b = len(y)
        seen = np.zeros((b, n), dtype=bool)
        spread = np.zeros((b, n), dtype=bool)
        beam = np.full((b, BEAM), -1, dtype=np.int64)
        sims = np.full((b, BEAM), -np.inf)
        first = np.tile(start, (b, 1))
        first = np.hstack([first, np.where(mine >= 0, mine, start[0])[:, None]])
        around, ball_of = np.nonzero(y @ x[leads].T >= low)
        row = np.concatenate([np.repeat(np.arange(b), first.shape[1]), around])
        node = np.concatenate([first.ravel(), leads[ball_of]])
        hits_row, hits_node = [], []
        while len(row):
            code = np.unique(row * n + node)
            row, node = code // n, code % n
            new = ~seen[row, node]
            row, node = row[new], node[new]
            seen[row, node] = True
            value = np.einsum("ij,ij->i", y[row], x[node])
            inside = value >= low
            hits_row.append(row[inside])
            hits_node.append(node[inside])
            count = np.bincount(row, minlength=b)
            width = int(count.max()) if len(row) else 0
            more = np.full((b, width), -1, dtype=np.int64)
            more_sims = np.full((b, width), -np.inf)
            column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            more[row, column], more_sims[row, column] = node, value
            pool, pool_sims = np.hstack([beam, more]), np.hstack([sims, more_sims])
            best = np.argsort(-pool_sims, axis=1, kind="stable")[:, :BEAM]
            beam, sims = np.take_along_axis(pool, best, axis=1), np.take_along_axis(pool_sims, best, axis=1)
            open_ = (beam >= 0) & ~spread[np.arange(b)[:, None], np.maximum(beam, 0)]
            some = np.flatnonzero(open_.any(axis=1))
            node = beam[some, open_[some].argmax(axis=1)]
            spread[some, node] = True
            row = np.repeat(some, at[node + 1] - at[node])
            node = to[_ranges(at[node], at[node + 1] - at[node])]
        row, node = np.concatenate(hits_row), np.concatenate(hits_node)
        front_row, front = row, node
        while len(front):
            fresh = ~spread[front_row, front]
            front_row, front = front_row[fresh], front[fresh]
            spread[front_row, front] = True
            found_row, found = [], []
            for k in range(0, len(front), 20_000):
                r, f = front_row[k : k + 20_000], front[k : k + 20_000]
                size = at[f + 1] - at[f]
                r2, f2 = np.repeat(r, size), to[_ranges(at[f], size)]
                new = ~seen[r2, f2]
                code = np.unique(r2[new] * n + f2[new])
                r2, f2 = code // n, code % n
                seen[r2, f2] = True
                inside = np.einsum("ij,ij->i", y[r2], x[f2]) >= low
                found_row.append(r2[inside])
                found.append(f2[inside])
            front_row = np.concatenate(found_row) if found_row else front[:0]
            front = np.concatenate(found) if found else front[:0]
            row, node = np.concatenate([row, front_row]), np.concatenate([node, front])
        linked = np.einsum("ij,ij->i", y[row], x[node]) >= least
        queries.append(row[linked] + s)
        nodes.append(node[linked])
    return np.concatenate(queries), np.concatenate(nodes)


def compare_all(x: np.ndarray, q: np.ndarray, least: float):
    """Pairs (query, node) with cosine >= ``least``, every query compared with every node."""
    found = [np.nonzero(q[s : s + 256] @ x.T >= least) for s in range(0, len(q), 256)]
    queries = [row + 256 * k for k, (row, _) in enumerate(found)]
    return np.concatenate(queries), np.concatenate([node for _, node in found])


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the edges (u, v): each end with the component's least."""
    ids, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = code[: len(u)], code[len(u) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return ids, ids[label]


def _centroids(reps: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(label, centroid) from a bounded sample; labels that fit one shard have none."""
    counts = reps.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > SHARD)
    large = counts.orderBy(F.desc("n"), "label").limit(CENTROIDS // 2).collect()
    total = sum(r["n"] for r in large)
    if not large:
        return np.zeros(0), np.zeros((0, 0))
    names = [r["label"] for r in large]
    share = min(1.0, FIT_ON / total)
    sample = reps.where(F.col("label").isin(names)).where(
        F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    ).select("label", "unit").limit(2 * FIT_ON).toArrow()
    labels, x = sample.column("label").to_numpy(), matrix(sample.column("unit"))
    found_labels, found = [], []
    for r in large:
        own = x[labels == r["label"]]
        k = max(1, min(-(-r["n"] // SHARD), CENTROIDS // 2 * r["n"] // total, len(own)))
        c = own[np.random.default_rng(k).permutation(len(own))[:k]]
        for _ in range(8):
            near = (own @ c.T).argmax(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, near, own)
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(size > 0, sums / np.maximum(size, 1e-12), c)
        found_labels += [r["label"]] * k
        found.append(c)
    return np.array(found_labels), np.vstack(found)


_MEMBER = "cluster long, homes array<long>, vec_id long, label long, n long, unit array<double>"


def _deal(labels: np.ndarray, centroids: np.ndarray, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = matrix(batch.column("unit")), batch.column("label").to_numpy()
            member = np.zeros((len(x), len(labels) + 1), dtype=bool)
            for label in np.unique(own):
                rows, some = np.flatnonzero(own == label), np.flatnonzero(labels == label)
                if len(some):
                    near = x[rows] @ centroids[some].T
                    member[np.ix_(rows, some)] = near >= near.max(axis=1, keepdims=True) - margin
                else:
                    member[rows, -1] = True
            row, cluster = np.nonzero(member)
            # Labels without centroids are clusters of their own, told apart by the label.
            code = np.where(cluster < len(labels), cluster, -1)
            homes = np.concatenate([[0], np.cumsum(member.sum(axis=1))])
            lists = pa.ListArray.from_arrays(pa.array(homes, pa.int32()), pa.array(code, pa.int64()))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code, pa.int64()), lists.take(take), *(batch.column(c).take(take) for c in ("vec_id", "label", "n", "unit"))],
                ["cluster", "homes", "vec_id", "label", "n", "unit"],
            )

    return run


def _build(least: float):
    def run(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("unit"))
        a, b, leads = pruned_graph(x, least)
        at = np.searchsorted(a, np.arange(len(ids) + 1))
        to = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids[b]))
        return pa.table({"vec_id": ids, "adjacent": to, "leads": np.isin(np.arange(len(ids)), leads)})

    return run


_FOUND = "vec_id long, other long, links long"


def _search(least: float, exact: bool):
    def run(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({k: np.zeros(0, np.int64) for k in ("vec_id", "other", "links")})
        if not nodes.num_rows or not asked.num_rows:
            return none
        ids, x = nodes.column("vec_id").to_numpy(), matrix(nodes.column("unit"))
        order = np.argsort(ids)
        lists = nodes.column("adjacent").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)
        here = ids[order][place] == flat
        owner = np.repeat(np.arange(len(ids)), size)[here]
        to, at = order[place][here], np.searchsorted(owner, np.arange(len(ids) + 1))
        query_ids, q = asked.column("vec_id").to_numpy(), matrix(asked.column("unit"))
        place = np.minimum(np.searchsorted(ids[order], query_ids), len(ids) - 1)
        own = np.where(ids[order][place] == query_ids, order[place], -1)
        if exact:
            row, node = compare_all(x, q, least)
        else:
            leads = np.flatnonzero(nodes.column("leads").to_numpy(zero_copy_only=False))
            row, node = range_search(x, at, to, leads, q, own, least)
        if (own >= 0).all():
            # The same vectors on both sides: what one end finds, the other has found too.
            back = np.full(len(ids), -1)
            back[own] = np.arange(len(own))
            both = back[node] >= 0
            code = np.unique(np.concatenate([row * len(ids) + node, back[node][both] * len(ids) + own[row][both]]))
            row, node = code // len(ids), code % len(ids)
        apart = query_ids[row] != ids[node]
        row, node = row[apart], node[apart]
        if not len(row):
            return none
        cluster = asked.column("cluster")[0].as_py()
        query_homes, node_homes = asked.column("homes").to_pylist(), nodes.column("homes").to_pylist()
        alone = np.array([len(h) == 1 for h in query_homes])[row] | np.array([len(h) == 1 for h in node_homes])[node]
        first = alone.copy()
        for k in np.flatnonzero(~alone).tolist():
            first[k] = min(set(query_homes[row[k]]) & set(node_homes[node[k]])) == cluster
        weight = nodes.column("n").to_numpy()
        links = np.bincount(row[first], weights=weight[node[first]], minlength=len(query_ids)).astype(np.int64)
        some = np.flatnonzero(links)
        u, root = _forest(query_ids[row], ids[node])
        return pa.table({
            "vec_id": np.concatenate([query_ids[some], u]),
            "other": np.concatenate([query_ids[some], root]),
            "links": np.concatenate([links[some], np.zeros(len(u), np.int64)]),
        })

    return run


def _found(
    reps: DataFrame, labels: np.ndarray, centroids: np.ndarray, margin: float, least: float, exact: bool = False
) -> DataFrame:
    """(vec_id, other, links): links counted per vector, and a forest of linked pairs."""
    dealt = stage(reps.mapInArrow(_deal(labels, centroids, margin), _MEMBER))
    keys = ["label", "cluster"]
    blocks = dealt.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int").alias("block")
    members = stage(dealt.join(blocks, keys).select(*dealt.columns, "blocks", block))
    graph = members.groupBy(*keys, "block").applyInArrow(_build(least), "vec_id long, adjacent array<long>, leads boolean")
    united = graph.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("adjacent"))).alias("adjacent"), F.max("leads").alias("leads"))
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    nodes = members.join(united, "vec_id").withColumn("asking", every)
    # Read anew, as a frame of its own: the other side of the same table.
    again = reps.sparkSession.read.schema(members.schema).parquet(members.staged_path)
    asked = again.withColumnRenamed("block", "asking").withColumn("block", every)
    group = [*keys, "block", "asking"]
    out = stage(
        nodes.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(_search(least, exact), _FOUND)
    )
    discard(dealt, members)
    return out


def _audit(reps: DataFrame, found: DataFrame, least: float) -> float:
    """Share of the links of ``AUDITED`` vectors, drawn from all, that were found; 1 where they have none."""
    # About twice as many are looked at, so that the choice does not send rows of every task to one.
    order, n = F.xxhash64("vec_id", F.lit(4)), reps.count()
    some = F.pmod(order, F.lit(1 << 40)) < int(2 * AUDITED / max(n, 1) * (1 << 40)) + 1
    sample = reps.where(some).orderBy(order).limit(AUDITED).select("vec_id", "label", "unit").toArrow()
    if not sample.num_rows:
        return 1.0
    ids, labels, q = sample.column("vec_id").to_numpy(), sample.column("label").to_numpy(), matrix(sample.column("unit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = batch.column("label").to_numpy()[:, None] == labels
                same &= batch.column("vec_id").to_numpy()[:, None] != ids
                hit = same & (matrix(batch.column("unit")) @ q.T >= least)
                n = batch.column("n").to_numpy() @ hit
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["vec_id", "n"])

    true = reps.select("vec_id", "label", "n", "unit").mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg(
        F.sum("n").alias("n")
    )
    got = found.groupBy("vec_id").agg(F.sum("links").alias("got"))
    want, have = true.join(got, "vec_id", "left").agg(F.sum("n"), F.sum(F.coalesce("got", F.lit(0)))).first()
    return have / want if want else 1.0


def near_vectors(embeddings: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``embeddings`` (vec_id, embedding,
    label).

    Two vectors are linked if their labels are equal and not null and their cosine is at least
    ``least``. Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing, nor do vectors of another length than the commonest (of equally
    common ones the longest); a row without vec_id has no component
    and is kept. vec_ids are taken to be distinct.
    """
    ready = stage(
        sound(embeddings, "label").where("label IS NOT NULL").withColumn("size", F.size("x"))
        .select("vec_id", F.col("label").cast("long").alias("label"), "size", "x",
                F.transform("x", lambda v: v / F.col("norm")).alias("unit"))
    )
    # One row per length that occurs.
    common = ready.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    usable = ready.where(F.col("size") == (common["size"] if common else 0))
    classes = usable.groupBy("label", "x").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("unit").alias("unit")
    )
    reps = stage(classes.select(F.col("rep").alias("vec_id"), "label", "n", "unit", "x"))
    homes = usable.join(
        reps.select("label", "x", F.col("vec_id").alias("rep"), "n"), ["label", "x"]
    ).select("vec_id", "rep", "n")
    bare = reps.drop("x")
    labels, centroids = _centroids(bare)
    for margin in MARGINS if len(labels) else MARGINS[:1]:
        found = _found(bare, labels, centroids, margin, least)
        if _audit(bare, found, least) >= RECALL:
            break
        discard(found)
    else:
        found = _found(bare, labels[:0], centroids[:0], 0.0, least, exact=True)
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
    linked = components(found.where("vec_id <> other"), "vec_id", "other").toDF("rep", "component")
    known = (
        homes.join(counts, "rep", "left").join(linked, "rep", "left")
        .select(
            "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = stage(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).join(known, "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
    discard(ready, reps, found)
    return out
