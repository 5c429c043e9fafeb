"""Embedding near-duplicates: an exact metric range join by cosine within a label.

On unit vectors a cosine bound is a distance bound r. Pivots cut the vectors of a label into cells, each vector's home
being its nearest pivot. If w lies within r of v and in the cell of pivot q, the triangle inequality gives
d(v, q) <= d(v, p) + 2r for v's own pivot p, and as w is no farther from q than from p, v is no farther than r from the
plane between them; so v is also sent to every cell for which both hold. Within a large cell the triangle inequality
decides again: its vectors lie in rings of width r around the pivot, and a vector only meets its own ring and the two
beside it. Cells (rings) of many home vectors are joined in blocks of bounded size, each on its own, as matrix products.
Equal vectors are one row with a count, so a group of copies costs one comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm._batches import stored
from partwise.llm._graph import components

COSINE, CELL, MOST_PIVOTS, SAMPLE = 0.93, 4096, 1024, 4096
FEW = 16  # different vectors of a label that need no pivots
_SLACK = 1e-9


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def _local_roots(near: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id reachable) over the links of a block: as many rows as ids, and no link between ids is lost."""
    above, beside, far = rows.copy(), cols.copy(), np.iinfo(np.int64).max
    while len(rows):
        up = np.minimum(above, np.where(near, beside, far).min(1))
        over = np.minimum(beside, np.where(near, up[:, None], far).min(0))
        if np.array_equal(up, above) and np.array_equal(over, beside):
            break
        above, beside = up, over
    a, b = np.concatenate([rows, cols]), np.concatenate([above, beside])
    found = np.unique(np.stack([a, b], 1)[a != b], axis=0)
    return found[:, 0], found[:, 1]


def spread(x: np.ndarray, most: int) -> np.ndarray:
    """At most `most` rows of x, each the one farthest from those before it."""
    taken, far = [0], _distances(x, x[:1])[:, 0]
    while len(taken) < min(most, len(x)) and far.max() > 1e-6:
        taken.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[taken[-1:]])[:, 0])
    return x[taken]


def _pivots(classes: DataFrame, large: DataFrame, most: int, sample: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors, the same for all labels: from at most `sample` vectors (the smallest hashes) of large labels.

    Pivots only steer the work; a length of which the sample has no vector has a single cell.
    """
    some = classes.join(large.select("group"), "group", "left_semi").select("v").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    rows: dict[int, list] = {}
    for r in some:
        rows.setdefault(len(r.v), []).append(r.v)
    return {size: spread(_unit(v), most) for size, v in rows.items()}


def _sent(classes: DataFrame, large: DataFrame, pivots: dict[int, np.ndarray], radius: float) -> DataFrame:
    """(cell, home, d, id, times, v): each vector in its home cell and in those that a vector near it may be at home in; d to the cell's pivot.

    large has a row for each label that is cut, with the number k of its pivots, the first ones of the list.
    """
    between = {size: _distances(p, p) for size, p in pivots.items()}

    def cells_of(batch: pa.RecordBatch, size: int, k: int) -> pa.RecordBatch:
        """Rows of one length and number of pivots; one cell where there are no pivots."""
        groups = batch.column(0).to_pylist()
        own = pivots.get(size, np.zeros((0, size)))[:k]
        if not len(own):
            i, j, home, d = np.arange(len(groups)), np.zeros(len(groups), int), np.zeros(len(groups), int), np.zeros((len(groups), 1))
        else:
            d = _distances(_unit(batch.column(1).to_pylist()), own)
            home = d.argmin(1)
            nearest = d[np.arange(len(groups)), home][:, None]
            plane = (d * d - nearest * nearest) <= 2 * radius * between[size][home, : len(own)] + _SLACK
            i, j = np.nonzero((d <= nearest + 2 * radius + _SLACK) & plane)
        picked = pa.array(i)
        cells = pa.array([f"{groups[a]}|{c}" for a, c in zip(i.tolist(), j.tolist())])
        return pa.RecordBatch.from_arrays([cells, pa.array(home[i] == j), pa.array(d[i, j]), batch.column(2).take(picked), batch.column(3).take(picked), batch.column(1).take(picked)], ["cell", "home", "d", "id", "times", "v"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, wanted = np.array(batch.column(1).value_lengths().to_numpy(zero_copy_only=False), np.int64), batch.column(4).to_numpy()
            for size, k in np.unique(np.stack([length, wanted], 1), axis=0).tolist():
                rows = batch.take(pa.array(np.flatnonzero((length == size) & (wanted == k))))
                step = max(1, 16_384 // max(1, k))  # a row may go to each of k cells
                for start in range(0, len(rows), step):
                    yield cells_of(rows.slice(start, step), size, k)

    marked = classes.join(large, "group", "left").select("group", "v", "id", "times", F.coalesce("k", F.lit(0)).alias("k"))
    return marked.mapInArrow(dealt, "cell string, home boolean, d double, id long, times long, v array<double>")


def replicated(classes: DataFrame, radius: float, cell: int = CELL, most_pivots: int = MOST_PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """_sent of classes (group, v, id, times), with pivots for every group of more than FEW vectors.

    A large group has as many cells as it has blocks of `cell` vectors, so that cells do not cost more copies than blocks
    would; a smaller one has up to eight.
    """
    n = F.col("n")
    wanted = F.least(F.greatest(F.ceil(n / cell), F.least(F.ceil(F.sqrt(n) / 2), F.lit(8))), F.lit(most_pivots)).cast("int")
    large = stored(classes.groupBy("group").agg(F.count("*").alias("n")).where(n > FEW).select("group", wanted.alias("k")))
    return _sent(classes, large, _pivots(classes, large, most_pivots, sample), radius)


def _blocked(sent: DataFrame, radius: float, cell: int) -> DataFrame:
    """(cell, ring, block, other, id, times, v): home vectors of each block (other 0) and all that may be near one of them (other 1)."""
    large = stored(sent.groupBy("cell").agg(F.count(F.when(F.col("home"), 1)).alias("homes")).where("homes > 0").select("cell", (F.col("homes") > cell).alias("cut")))
    ringed = sent.join(large, "cell").withColumn("ring", F.when(F.col("cut"), F.floor(F.col("d") / radius)).otherwise(0).cast("int"))
    rings = stored(ringed.where("home").groupBy("cell", "ring").agg(F.ceil(F.count("*") / cell).cast("int").alias("blocks")))
    own = ringed.where("home").join(rings, ["cell", "ring"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    beside = F.when(F.col("cut"), F.sequence(F.floor((F.col("d") - radius - _SLACK) / radius).cast("int"), F.floor((F.col("d") + radius + _SLACK) / radius).cast("int"))).otherwise(F.array(F.lit(0)))
    other = ringed.drop("ring").withColumn("ring", F.explode(beside)).join(rings, ["cell", "ring"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = ("cell", "ring", "block", "other", "id", "times", "v")
    return own.withColumn("other", F.lit(0)).select(*names).unionByName(other.withColumn("other", F.lit(1)).select(*names))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, cell: int = CELL, most_pivots: int = MOST_PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vec_id, embedding and label.

    Vectors of one label, not null, link when their cosine in double precision is at least `cosine` (above 0); n_links
    counts other rows linked directly, component_id is the smallest vec_id reachable by links. Null, zero, empty or
    non-finite vectors, and those of a null label or id, link with nothing; vectors of other lengths never link; equal
    rows link with each other; an empty table gives an empty result; other columns are ignored. Labels of more than
    `cell` different vectors are cut by pivots, which are chosen from `sample` vectors and only steer the work.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"), F.col("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce((F.size("v") > 0) & finite, F.lit(False))
    rows = rows.withColumn("usable", usable).withColumn("group", F.concat_ws("|", F.col("label").cast("string"), F.size("v").cast("string")))
    classes = stored(rows.where("usable").groupBy("group", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("times")))
    radius = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    sent = stored(replicated(classes, radius, cell, most_pivots, sample))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, x = None, np.zeros(0, np.int64), np.zeros((0, 1))
        waiting: list[pa.RecordBatch] = []

        def matched(part: pa.RecordBatch) -> pa.RecordBatch:
            theirs, times = part.column(4).to_numpy(), part.column(5).to_numpy()
            y = _unit(part.column(6).to_pylist())
            near = np.zeros((len(ids), len(theirs)), bool)
            for k in range(0, len(ids), 512):
                near[k : k + 512] = x[k : k + 512] @ y.T >= cosine
            near &= ids[:, None] != theirs
            rows_of, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            near = near[np.ix_(rows_of, cols)]
            a, b = _local_roots(near, ids[rows_of], theirs[cols])
            n = near @ times[cols]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, ids[rows_of]])), pa.array(np.concatenate([b, ids[rows_of]])), pa.array(np.concatenate([np.zeros(len(a), np.int64), n.astype(np.int64)]))], ["a", "b", "links"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if keys[start][:3] != key:
                    key, waiting, ids, x = keys[start][:3], [], np.zeros(0, np.int64), None
                if keys[start][3] == 0:
                    waiting.append(part)
                else:
                    if waiting:
                        ids = np.concatenate([p.column(4).to_numpy() for p in waiting])
                        x, waiting = np.concatenate([_unit(p.column(6).to_pylist()) for p in waiting]), []
                    if len(ids):
                        for k in range(0, len(part), 4096):
                            yield matched(part.slice(k, 4096))

    found = _blocked(sent, radius, cell).repartition("cell", "ring", "block").sortWithinPartitions("cell", "ring", "block", "other").mapInArrow(joined, "a long, b long, links long")
    found = stored(found)
    links = found.where("links > 0").groupBy("a").agg(F.sum("links").alias("links"))
    linked = components(found.where("links = 0").select("a", "b"))
    whole = stored(classes.join(links.withColumnRenamed("a", "id"), "id", "left").join(linked, "id", "left")
                   .select("group", "v", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    key = F.when(F.col("usable"), F.xxhash64("group", "v"))
    keyed = stored(rows.select("vec_id", "usable", "group", "v", key.alias("k")))
    match = whole.select(F.xxhash64("group", "v").alias("k"), F.col("group").alias("g2"), F.col("v").alias("v2"), "n_links", "component_id")
    yes = keyed.where("usable").join(match, "k").where("group = g2 and v = v2").select("vec_id", "n_links", "component_id")
    no = keyed.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return yes.unionByName(no).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
