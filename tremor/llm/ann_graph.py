"""Embedding near-dedup over a robust-pruned flat graph (operator 5).

Vectors of one label (and dimension) are dealt to overlapping shards around
sampled pivots, thinned so that no two lie near one another: home at the
nearest, guest at those whose cell a vector within the range may have for its
home. A shard over BLOCK rows (a dense family) is split into blocks, and every
block meets every other and itself, by brute force. Each other shard builds a graph: a vector's nearest candidates, robustly
pruned (a neighbour goes if a kept one is nearer to it by the factor alpha),
with reverse edges. The lists of a vector from all its shards are united, and
every vector is searched in its home shard over the united graph: greedily
from the shard's medoid, then range-expanding, from all that is found within
the range (with some slack) to its neighbours, until nothing new is near.
Links are verified by cosine in double precision.

Pairs never leave a shard: a shard passes on how many links each of its
vectors has and, for components, one link from each vector to the least of
those connected inside the shard. An audit measures the recall of links by
brute force for a stated, bounded set of vectors against all rows, and for as many that have links;
below the target the index is built again with more overlap, at last without
a cap on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.components import connected_components
from tremor.session import materialize

THRESHOLD = 0.98
#: Home vectors of a shard on average; the most pivots (the sampled, broadcast part of the index: 33 MB at 64 dimensions).
SHARD_ROWS, MAX_PIVOTS = 500, 65536
#: A vector is in at most OVERLAP shards at first; rebuilds double it up to the number of pivots.
OVERLAP = 4
#: Rows of a shard that one task takes by its graph; larger shards are compared in pairs of blocks of so many rows.
BLOCK = 4096
#: Graph: candidates, degree, pruning factor; search: beam, and how far below the threshold it still walks.
CANDIDATES, DEGREE, ALPHA, BEAM, SLACK = 48, 16, 1.2, 8, 0.05
AUDIT_ROWS, TARGET_RECALL, LEAST_RECALL = 128, 0.95, 0.9


def unit_rows(vectors) -> np.ndarray:
    """Rows of length one in double precision."""
    x = np.asarray(np.stack([np.asarray(v, np.float64) for v in vectors]))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_candidates(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the k most similar other rows (nearest first) and their cosines, a block of rows at a time."""
    m = len(x)
    k = min(k, m - 1)
    idx, cos = np.zeros((m, k), np.int64), np.zeros((m, k))
    for a in range(0, m, 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        part = np.argpartition(-s, k - 1, axis=1)[:, :k]
        c = np.take_along_axis(s, part, 1)
        order = np.argsort(-c, axis=1, kind="stable")
        idx[a : a + 512], cos[a : a + 512] = np.take_along_axis(part, order, 1), np.take_along_axis(c, order, 1)
    return idx, cos


def robust_prune(x: np.ndarray, idx: np.ndarray, cos: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each row among its candidates (nearest first), at most ``degree``.

    A candidate is kept unless a kept neighbour is nearer to it, by the factor
    alpha on distances, than the row itself.
    """
    m, k = idx.shape
    kept, count = np.full((m, degree), -1, np.int64), np.zeros(m, np.int64)
    dist = np.sqrt(np.maximum(2 - 2 * cos, 0))
    for j in range(k):
        c = idx[:, j]
        blocked = np.zeros(m, bool)
        for r in range(int(count.max()) if j else 0):
            has = (count > r) & ~blocked
            if has.any():
                d = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x[kept[has, r]], x[c[has]]), 0))
                blocked[has] = alpha * d <= dist[has, j]
        add = ~blocked & (count < degree)
        kept[add, count[add]] = c[add]
        count += add
    return [kept[i, : count[i]] for i in range(m)]


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row, with reverse edges."""
    m = len(x)
    if m < 2:
        return [np.zeros(0, np.int64) for _ in range(m)]
    out = robust_prune(x, *nearest_candidates(x, CANDIDATES))
    src = np.concatenate([np.full(len(o), i) for i, o in enumerate(out)])
    dst = np.concatenate(out)
    a, b = np.concatenate([src, dst]), np.concatenate([dst, src])
    key = np.unique(a * m + b)
    a, b = key // m, key % m
    return np.split(b, np.searchsorted(a, np.arange(1, m)))


def range_search(x: np.ndarray, graph: list[np.ndarray], medoid: int, q: int, threshold: float = THRESHOLD) -> np.ndarray:
    """Rows found at a cosine of ``threshold`` or more from row ``q``, itself left out.

    A beam walks greedily from the medoid; what it ends with and the row's own
    neighbours seed the expansion over rows within ``threshold - SLACK``.
    """
    seen = np.zeros(len(x), bool)
    beam = np.array([medoid])
    score = x[beam] @ x[q]
    seen[beam] = True
    best = -2.0
    while score.max() > best:
        best = score.max()
        new = np.unique(np.concatenate([graph[i] for i in beam]))
        new = new[~seen[new]]
        if not len(new):
            break
        seen[new] = True
        beam, score = np.append(beam, new), np.append(score, x[new] @ x[q])
        top = np.argsort(-score, kind="stable")[:BEAM]
        beam, score = beam[top], score[top]
    seen[:] = False
    seen[q] = True
    front = np.unique(np.concatenate([beam, graph[q], [q]]))
    found = []
    while len(front):
        seen[front] = True
        cos = x[front] @ x[q]
        found.append(front[cos >= threshold])
        walk = front[cos >= threshold - SLACK]
        if not len(walk):
            break
        front = np.unique(np.concatenate([graph[i] for i in walk]))
        front = front[~seen[front]]
    hits = np.unique(np.concatenate(found))
    return hits[hits != q]


def thin(p: np.ndarray, most: float) -> np.ndarray:
    """Pivots of which no two have a cosine of ``most`` or more: each goes that is so near to one before it."""
    kept = p[:0]
    for a in range(0, len(p), 256):
        part = p[a : a + 256]
        if len(kept):
            part = part[(part @ kept.T).max(axis=1) < most]
        near, own = part @ part.T >= most, []
        for i in range(len(part)):
            if not near[i, own].any():
                own.append(i)
        kept = np.concatenate([kept, part[own]])
    return kept


def cells(x: np.ndarray, p: np.ndarray, overlap: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the ``overlap`` pivots of which it may be a guest, its home first, and whether it is.

    A vector within the threshold of x lies at most ``reach`` away, so its
    home is another pivot only if x is that near to the plane between the two.
    Without a cap, every pair within the threshold meets in a home of one.
    """
    reach = np.sqrt(2 - 2 * threshold) + 1e-9
    s = x @ p.T
    home = s.argmax(axis=1)
    at, of = np.unique(home, return_inverse=True)
    apart = np.sqrt(np.maximum(2 - 2 * (p[at] @ p.T), 1e-30))[of]
    away = (s[np.arange(len(x)), home][:, None] - s) / apart
    away[np.arange(len(x)), home] = -1
    top = np.argsort(away, axis=1, kind="stable")[:, :overlap]
    return top, np.take_along_axis(away, top, 1) <= reach


def _assign(pivots, overlap: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pivots.value
        for b in batches:
            vec, group, many, emb = (b.column(i) for i in range(4))
            group = group.to_pylist()
            rows, shard, home, others = [], [], [], []
            by_group: dict[str, list[int]] = {}
            for i, g in enumerate(group):
                by_group.setdefault(g, []).append(i)
            for g, at in by_group.items():
                if g not in known:
                    rows += at
                    shard += [f"{g}/0"] * len(at)
                    home += [True] * len(at)
                    others += [[f"{g}/0"]] * len(at)
                    continue
                p = known[g]
                for a in range(0, len(at), 1024):
                    part = at[a : a + 1024]
                    for i, t, near in zip(part, *cells(unit_rows([emb[i].values.to_numpy() for i in part]), p, overlap, threshold), strict=True):
                        names = [f"{g}/{j}" for j in t[near]]
                        rows += [i] * len(names)
                        shard += names
                        home += [True] + [False] * (len(names) - 1)
                        others += [names] * len(names)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.string()), vec.take(take), many.take(take), pa.array(home, pa.bool_()), pa.array(others, pa.list_(pa.string())), emb.take(take)], ["shard", "vec", "many", "home", "shards", "emb"])

    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec", ignore_index=True)
    graph = build_graph(unit_rows(pdf["emb"]))
    ids = pdf["vec"].to_numpy()
    return pd.DataFrame({"vec": ids, "near": [ids[g].tolist() for g in graph]})


def _search(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec", ignore_index=True)
        ids, home, many = pdf["vec"].to_numpy(), pdf["home"].to_numpy(), pdf["many"].to_numpy()
        shard = pdf["shard"].iloc[0]
        x = unit_rows(pdf["emb"])
        graph = []
        for near in pdf["near"]:
            near = np.asarray(near, np.int64) if near is not None else np.zeros(0, np.int64)
            at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
            graph.append(at[ids[at] == near])
        mean = x.mean(axis=0)
        medoid = int(np.argmax(x @ mean))
        homes = [s[0] for s in pdf["shards"]]
        members = [set(s) for s in pdf["shards"]]
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for q in np.flatnonzero(home):
            hits = range_search(x, graph, medoid, int(q), threshold)
            links[q] += many[hits].sum()
            # A guest whose home doesn't know the vector can't count the link itself.
            for h in hits[~home[hits]]:
                if homes[h] not in members[q]:
                    links[h] += many[q]
            for r in {find(h) for h in hits} - {find(q)}:
                a, b = sorted((find(q), r))
                root[b] = a
        least = np.array([find(i) for i in range(len(ids))])
        use = home | (links > 0) | (least != np.arange(len(ids)))
        return pd.DataFrame({"vec": ids[use], "links": links[use], "root": ids[least[use]]})

    return run


def _compare(threshold: float):
    """Links between two blocks of a shard, or inside one, counted as :func:`_search` does: by a vector at
    home, and by a guest where its own home doesn't hold the other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec", ignore_index=True)
        ids, home, many, block = (pdf[c].to_numpy() for c in ("vec", "home", "many", "block"))
        x = unit_rows(pdf["emb"])
        code: dict[str, int] = {}
        own = np.array([code.setdefault(s[0], len(code)) if not h else -1 for s, h in zip(pdf["shards"], home, strict=True)])
        #: Whether the home of each guest here (by code) holds a row; the last line, for rows at home, says no.
        holds = np.zeros((len(code) + 1, len(ids)), bool)
        for j, names in enumerate(pdf["shards"]):
            for name in names:
                if name in code:
                    holds[code[name], j] = True
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        one = block.min() == block.max()
        # A pair of blocks leaves out what lies inside a block, which has a task of its own.
        sides = [(np.arange(len(ids)),) * 2] if one else [(np.flatnonzero(block == v), np.flatnonzero(block != v)) for v in (block.min(), block.max())]
        for k, (mine, other) in enumerate(sides):
            y = x[other]
            for a in range(0, len(mine), 256):
                part = mine[a : a + 256]
                hit = x[part] @ y.T >= threshold
                if one:
                    hit[np.arange(len(part)), part] = False
                count = hit & (home[part][:, None] | (home[other][None, :] & ~holds[own[part]][:, other]))
                links[part] += (count @ many[other].astype(np.float64)).astype(np.int64)
                if k:
                    continue
                for i, h in zip(part, hit, strict=True):
                    if h.any():
                        both = np.unique(np.append(label[other[h]], label[i]))
                        if len(both) > 1:
                            label[np.isin(label, both)] = both[0]
        use = (links > 0) | (label != np.arange(len(ids)))
        return pd.DataFrame({"vec": ids[use], "links": links[use], "root": ids[label[use]]})

    return run


def _pivots(reps: DataFrame, threshold: float) -> dict[str, np.ndarray]:
    """Sampled pivots by group, thinned to less than the cosine that a search still walks."""
    n = reps.count()
    rate = min(1 / SHARD_ROWS, MAX_PIVOTS / max(2 * n, 1))
    sample = reps.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).limit(MAX_PIVOTS)
    groups: dict[str, list] = {}
    for r in sample.select("group", "vec", "emb").collect():
        groups.setdefault(r["group"], []).append((r["vec"], r["emb"]))
    return {g: thin(unit_rows([e for _, e in sorted(v)]), threshold - SLACK) for g, v in groups.items()}


def _index(reps: DataFrame, known: dict[str, np.ndarray], threshold: float, overlap: int) -> DataFrame:
    """``vec, links, root`` of the distinct vectors, some rows per vector."""
    spark = reps.sparkSession
    pivots = spark.sparkContext.broadcast(known)
    rows = reps.select("vec", "group", "many", "emb").mapInArrow(_assign(pivots, overlap, threshold), "shard string, vec long, many long, home boolean, shards array<string>, emb array<double>")
    rows = materialize(rows, "ann-shards")
    large = F.broadcast(rows.groupBy("shard").count().where(f"count > {BLOCK}").select("shard", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))  # of MAX_PIVOTS shards at most
    rows = rows.join(large, "shard", "left")
    small = rows.where("blocks is null").drop("blocks")
    lists = small.select("shard", "vec", "emb").groupBy("shard").applyInPandas(_build, "vec long, near array<long>")
    united = lists.groupBy("vec").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # of ``overlap`` shards at most
    united = materialize(united, "ann-graph")
    found = materialize(small.join(united, "vec", "left").groupBy("shard").applyInPandas(_search(threshold), "vec long, links long, root long"), "ann-links")
    block = rows.where("blocks is not null").withColumn("block", F.pmod(F.xxhash64("vec"), "blocks").cast("int"))
    tasks = block.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"a": F.least("block", "with"), "b": F.greatest("block", "with")})
    split = tasks.select("shard", "a", "b", "block", "vec", "many", "home", "shards", "emb").groupBy("shard", "a", "b")
    return found.union(materialize(split.applyInPandas(_compare(threshold), "vec long, links long, root long"), "ann-blocks"))


def audit(reps: DataFrame, counted: DataFrame, threshold: float, rows: int = AUDIT_ROWS) -> float:
    """Recall of links: brute force against all rows, for ``rows`` vectors (those of the smallest hash) and for
    ``rows`` of those that have links; the lower of the two.

    ``counted`` has ``vec, n`` for every distinct vector with links.
    """
    linked = reps.join(counted.where("n > 0").select("vec"), "vec", "left_semi")
    return min(_recall(reps, x.orderBy(F.xxhash64("vec"), "vec").limit(rows), counted, threshold) for x in (reps, linked))


def _recall(reps: DataFrame, some: DataFrame, counted: DataFrame, threshold: float) -> float:
    asked = some.select("vec", "group", "emb").collect()
    if not asked:
        return 1.0
    by_group: dict[str, tuple[list[int], list]] = {}
    for r in asked:
        ids, vectors = by_group.setdefault(r["group"], ([], []))
        ids.append(r["vec"])
        vectors.append(r["emb"])
    held = {g: (np.array(i), unit_rows(v)) for g, (i, v) in by_group.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            vec, group, many = b.column(0).to_numpy(), np.array(b.column(1).to_pylist()), b.column(2).to_numpy()
            for g, (ids, q) in held.items():
                at = np.flatnonzero(group == g)
                for a in range(0, len(at), 2048):
                    part = at[a : a + 2048]
                    hit = unit_rows([b.column(3)[int(i)].values.to_numpy() for i in part]) @ q.T >= threshold
                    hit &= vec[part][:, None] != ids[None, :]
                    for i, n in zip(ids, many[part] @ hit, strict=True):
                        total[int(i)] = total.get(int(i), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["vec", "true"])

    true = reps.select("vec", "group", "many", "emb").mapInArrow(run, "vec long, true long").groupBy("vec").agg(F.sum("true").alias("true"))
    got = true.join(counted, "vec", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0))))).first()
    return 1.0 if not got[0] else got[1] / got[0]


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Vectors link when their labels are equal and not null, their dimensions
    are equal, and their cosine is ``threshold`` or more. Vectors that are
    null, empty or zero or hold null or non-finite values link with nothing.
    Equal vectors of a label are one vector with a multiplicity until the end,
    so copies cost nothing; rows equal in id, label and vector come out once;
    of a repeated vec_id with other vectors each row is a vector of its own
    with that id. Null vec_ids link with nothing. An empty table gives an
    empty result; other columns are ignored.

    Pivots are thinned, so a dense family has one and shares its shard; shards
    over BLOCK rows are compared block by block, and links are counted and
    never listed. Raises RuntimeError if even the index without a cap on the
    overlap finds less than LEAST_RECALL of the audited links.
    """
    e = F.col("emb")
    rows = embeddings.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("emb"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size("emb") > 0) & F.forall("emb", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("emb", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("group", F.concat_ws("#", "label", F.size("emb").cast("string"))).withColumn("h", F.when(F.col("ok"), F.concat(F.hex(F.xxhash64("group", "emb")), F.hex(F.xxhash64("emb", F.lit(1), "group")))))
    rows = materialize(rows.dropDuplicates(["id", "label", "emb"]), "ann-rows")
    reps = rows.where("ok").groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("many"), F.first("group").alias("group"), F.first("emb").alias("emb"))
    reps = materialize(reps, "ann-reps")
    # Inside, a vector goes by a hash of its own, since several may have one id; it is salted until no two are equal.
    for salt in range(8):
        named = reps.withColumn("vec", F.xxhash64("h", F.lit(salt)))
        if not named.groupBy("vec").count().where("count > 1").limit(1).count():
            break
    else:
        raise RuntimeError("no salt tells the vectors apart")
    reps = named
    known = _pivots(reps, threshold)
    most, overlap = max(map(len, known.values()), default=1), OVERLAP
    while True:
        found = _index(reps, known, threshold, overlap)
        counted = found.groupBy("vec").agg(F.sum("links").alias("n"))
        recall = audit(reps, counted, threshold)
        if recall >= TARGET_RECALL or overlap >= most:
            break
        overlap *= 2
    if recall < LEAST_RECALL:
        raise RuntimeError(f"the index finds {recall:.3f} of the audited links, less than {LEAST_RECALL}")
    reach = materialize(connected_components(found.select(F.col("vec").alias("a"), F.col("root").alias("b"))), "ann-reach")
    per = reps.join(counted, "vec", "left").join(reach, reps["vec"] == reach["node"], "left").select("h", "id", "many", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "vec").alias("c"))
    per = per.join(per.groupBy("c").agg(F.min("id").alias("component")), "c").select("h", "many", "n", "component")
    out = rows.join(per, "h", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce(F.col("n") + F.col("many") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
