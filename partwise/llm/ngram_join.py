"""N-gram Jaccard self-join of whole texts, exact, by partitioning the universe of shingles.

Method. The shingles of a text are hashed into segments, by a scheme of its size band. Linked sets differ in few
shingles, so by the pigeonhole principle they agree in a segment, or (where the scheme says so) agree but for one
shingle: such segments are indexed with their one-deletion neighbourhood. Schemes are allocated by cost from the
counts of all sets (ngram_sets.allocate). Sets that share a signature are candidates; links are decided on the words.

Scale. Equal sets are joined first, by fingerprint, so groups of copies are one set from there on. Signatures are
rows of 11 bytes that differ (48 bits of the signature and 40 that name the set), however many partitions they go to;
they are shuffled once and read sorted, one row at a time. In each bucket the first member is compared with
the rest; so a group of near copies costs as many comparisons as it has members. Where components are left apart, another
member, first by a hash, meets the rest of the other components. Only buckets that still hold different
components go on: those of a few members as pairs of ids, and larger ones cut into pairs of blocks that are spread over
tasks. Their members get a bit sketch, whose distance is a lower bound of the sets' difference, and pairs beyond the bound
are left out, so that hardly a pair that does not link is sent on. No link between components is lost. Texts of candidates only are shuffled for the comparison. Signatures
that many sets share are salted, and buckets are joined with their leaders by Spark, which splits skewed ones.

Sets count as equal when their sizes and two independent 64-bit sums agree: for 10**10 different sets the chance that any
two of them are taken for one is below 10**-18. Signatures are 47-bit values; where two agree by chance, the only effect
is one more comparison. So it is where the 40-bit names of two sets agree, as sets of one name are also a bucket of their
own. Links between different sets are decided word by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm._batches import LOWER, dropped, flat, pieces, stored
from partwise.llm._graph import components
from partwise.llm.ngram_sets import allocate, allowed, fingerprints, shingle_sets, signatures

WORDS, PERCENT = 5, 80
_LEAST_BITS, _MOST_BITS = 23, 28
_PROBE = np.uint64(0x3FF)
_KEY_BITS, _HOT_BIT = 40, 1 << 16
_HOT, _BLOCK, _LEADERS, _LOWEST, _FEW = 256, 1024, 2, 8, 8
_TABLE = bytes(LOWER)


def _set_stats(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, fp1, fp2, probe) of every row: size of its set, fingerprints that equal sets share, and its part of a fixed 1024th of all shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                raw, at = flat(part.column(1))
                rows, hashes = shingle_sets(raw, at, words)
                n, fp1, fp2 = fingerprints(rows, hashes, len(part))
                own = np.flatnonzero(hashes & _PROBE == 0)
                probe = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[own], minlength=len(part)))]), pa.int32()), pa.array(hashes[own].view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(fp1), pa.array(fp2), probe], ["doc_id", "n", "fp1", "fp2", "probe"])

    return docs.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, probe array<long>")


def _met(stats: DataFrame) -> dict[int, tuple[float, float]]:
    """For each size band, the share of its elements that other sets have too, and how many sets on average (a row a band)."""
    once = stats.where("n > 1 and doc_id is not null").groupBy("n", "fp1", "fp2").agg(F.first("probe").alias("probe"))
    counts = once.select(F.floor(F.log2("n")).alias("band"), F.explode("probe").alias("e")).groupBy("band", "e").agg(F.count("*").alias("k"))
    counts = stored(counts)
    whole = counts.groupBy("e").agg(F.sum("k").alias("c"))
    more = F.when(F.col("c") > 1, F.col("k")).otherwise(0)
    rows = counts.join(whole, "e").groupBy("band").agg(F.sum("k").alias("all"), F.sum(more).alias("shared"), F.sum(more * (F.col("c") - 1)).alias("others")).collect()
    return {int(r.band): (r.shared / r.all, r.others / r.shared if r.shared else 0.0) for r in rows}


def _signature_rows(docs: DataFrame, words: int, percent: int, schemes: dict) -> DataFrame:
    """(sig, key) of every set; a set that a task has seen before is not signed again.

    key is the set's name: the lowest _KEY_BITS of fp1. sig has 47 bits of a signature, above the bit _HOT_BIT: it is set
    if _HOT sets of a piece of text share the signature, for their rows but two, which are then dealt by key as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                raw, at = flat(part.column(1))
                rows, hashes = shingle_sets(raw, at, words)
                _, fp1, fp2 = fingerprints(rows, hashes, len(part))
                new = np.zeros(len(part), bool)
                for i, f in enumerate(zip(fp1.tolist(), fp2.tolist())):
                    if f not in seen:
                        seen.add(f)
                        new[i] = True
                keep = new[rows]
                owner, sigs = signatures(rows[keep], hashes[keep], len(part), schemes, percent)
                sigs, key = sigs & -2 * _HOT_BIT, fp1[owner] & (1 << _KEY_BITS) - 1  # rows stay in the order of their sets, which keeps them small when compressed
                order = np.argsort(sigs, kind="stable")
                start = np.flatnonzero(np.r_[True, np.diff(sigs[order]) != 0]) if len(sigs) else np.zeros(0, np.int64)
                size = np.diff(np.r_[start, len(sigs)])
                two = (size >= _HOT) & (key[order[start]] != key[order[np.minimum(start + 1, len(sigs) - 1)]])  # the two that stay must tell each other
                rank = np.arange(len(sigs)) - np.repeat(start, size)
                sigs[order[np.repeat(two, size) & (rank > 1)]] |= _HOT_BIT
                yield pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(key)], ["sig", "key"])

    return docs.mapInArrow(run, "sig long, key long")


def _shared_buckets(rows: DataFrame) -> DataFrame:
    """The rows (sig, key) of signatures that two sets or more have, sig without the bit of hot ones.

    rows are those of _signature_rows. They are dealt by sig, hot ones by sig and a part of key, and sorted. A hot row
    stays; the two rows of its signature that are not hot tell the rows of tasks for which it was not hot that they are
    not alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), np.int64)  # the last, perhaps unfinished bucket: its first row or its last one
        told = False
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], 1)
            new = np.ones(at.shape[1], bool)
            new[1:] = (at[:, 1:] != at[:, :-1]).any(0)
            k = held.shape[1]
            k, at = int(new[:k].sum()), at[:, new]
            same = at[0, 1:] == at[0, :-1]
            many = at[0] & _HOT_BIT > 0
            many[1:] |= same
            many[:-1] |= same
            many[:k] &= not told
            told = bool(many[-1]) or (at.shape[1] == k and told)
            held = at[:, -1:]
            yield pa.RecordBatch.from_arrays([pa.array(at[0, many] & ~_HOT_BIT), pa.array(at[1, many])], ["sig", "key"])

    dealt = rows.repartition("sig", F.expr(f"if(sig & {_HOT_BIT} = 0, -1, key & 255)")).sortWithinPartitions("sig", "key")
    return dealt.mapInArrow(run, "sig long, key long")


def _members(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(sig, doc_id, n) of the sets (doc_id, n, fp1) of buckets (sig, key); sets of one key are a bucket besides."""
    named = sets.select(F.expr(f"fp1 & {(1 << _KEY_BITS) - 1}").alias("key"), "doc_id", "n")
    twice = stored(named.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select(F.expr("shiftleft(key, 17) + 1").alias("sig"), "key"))  # no signature is odd
    return buckets.unionByName(twice).join(named, "key").select("sig", "doc_id", "n")


def _leader_pairs(members: DataFrame, percent: int, order: Column) -> DataFrame:
    """(a, b, chunk), one row a pair: in each bucket the first member by order with every other of another label and of a size that a link allows.

    members has (sig, doc_id, n, label). Leaders are found by an aggregate and joined with the members as two stored
    tables, so the rows of a hot signature can be split over tasks. chunk cuts the partners of one a into parts of
    bounded size.
    """
    lead = F.min(F.struct(order.alias("o"), "doc_id", "n", "label")).alias("lead")
    leaders = stored(members.groupBy("sig").agg(lead, F.count("*").alias("size")).where("size > 1").select("sig", F.col("lead.doc_id").alias("first"), F.col("lead.n").alias("m"), F.col("lead.label").alias("own"), "size"))
    near = F.expr(f"own <> label and 100 * least(n, m) >= {percent} * greatest(n, m)")
    chunk = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / 128).cast("long")).cast("long")
    rows = members.select("sig", "doc_id", "n", "label").join(leaders, "sig").where(near).select(F.col("first").alias("a"), F.col("doc_id").alias("b"), chunk.alias("chunk"), "size")
    return rows.groupBy("a", "b").agg(F.max_by("chunk", "size").alias("chunk"))


def _sketches(texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, size, sketch): bit i is the parity of the set's elements that hash to i; one or two bits an element, by size band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                rows, hashes = shingle_sets(*flat(part.column(1)), words)
                n = np.bincount(rows, minlength=len(part))
                bits = np.maximum(64, 2 << (np.frexp(np.maximum(n, 1))[1] - 1)).astype(np.int64)
                base = np.concatenate([[0], np.cumsum(bits)])
                odd = np.bincount(base[rows] + (hashes.view(np.int64) & (bits[rows] - 1)), minlength=base[-1]) & 1
                packed = np.packbits(odd.astype(np.uint8), bitorder="little")
                sketch = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((base // 8).astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), sketch], ["doc_id", "size", "sketch"])

    return texts.mapInArrow(run, "doc_id long, size long, sketch binary")


def _near(left: list[tuple], right: list[tuple] | None, percent: int, sig: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b) of the pairs of two blocks' (doc, n, label, sketch, lowest), or of one block's, that differ in label and may link.

    Sketches of two sets differ in no more bits than the sets in elements, so what is left out cannot link. A pair that
    also shares one of its lowest signatures below this one is told there, not here.
    """
    far = np.iinfo(np.int64).max

    def by_width(rows: list[tuple]) -> dict[int, tuple]:
        groups: dict[int, list[tuple]] = {}
        for row in rows:
            groups.setdefault(len(row[3]), []).append(row)
        return {w: (*(np.array([r[i] for r in g], np.int64) for i in range(3)), np.frombuffer(b"".join(r[3] for r in g), np.uint64).reshape(len(g), -1),
                    np.array([[*r[4], *[far] * (_LOWEST - len(r[4]))] for r in g], np.int64)) for w, g in groups.items()}

    one = by_width(left)
    two = one if right is None else by_width(right)
    for width, (doc, n, label, bits, low) in one.items():
        for wide in (width // 2, width, 2 * width):
            if wide not in two or right is None and wide < width:
                continue
            doc2, n2, label2, bits2, low2 = two[wide]
            own = bits
            if wide > width:
                bits2 = bits2[:, : bits.shape[1]] ^ bits2[:, bits.shape[1] :]
            elif wide < width:
                own = bits[:, : bits2.shape[1]] ^ bits[:, bits2.shape[1] :]
            may = (label[:, None] != label2) & (doc[:, None] != doc2 if right is not None or wide > width else doc[:, None] < doc2) & (100 * np.minimum(n[:, None], n2) >= percent * np.maximum(n[:, None], n2))
            i, j = np.nonzero(may)
            most = max(1, (1 << 20) // own.shape[1])
            for c in range(0, len(i), most):
                x, y = i[c : c + most], j[c : c + most]
                ok = np.bitwise_count(own[x] ^ bits2[y]).sum(1) <= allowed(np.minimum(n[x], n2[y]), percent)
                x, y = x[ok], y[ok]
                told = np.zeros(len(x), bool)
                for k in range(_LOWEST):
                    told |= ((low[x] == low2[y, k][:, None]) & (low2[y, k] < sig)[:, None]).any(1)
                x, y = x[~told], y[~told]
                if len(x):
                    yield np.minimum(doc[x], doc2[y]), np.maximum(doc[x], doc2[y])


def _few_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b, chunk) of all pairs in buckets of at most _FEW members (sig, doc_id, n, label) that differ in label and have sizes that a link allows."""
    buckets = members.groupBy("sig").agg(F.collect_list(F.struct("doc_id", "n", "label")).alias("m"))
    pairs = buckets.select("m", F.explode("m").alias("x")).select("x", F.explode("m").alias("y"))
    may = F.expr(f"x.doc_id < y.doc_id and x.label <> y.label and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    return pairs.where(may).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.expr("pmod(y.doc_id, 16L)").alias("chunk"))


def _near_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b, chunk) of all buckets, from (sig, doc_id, n, label, sketch, lowest, size): the pairs of each that differ in label and may link.

    A bucket of size members is cut into blocks by the hash of doc_id, and each pair of blocks is a group of its own, of
    about twice _BLOCK rows, so the pairs of a large bucket are spread over tasks.
    """
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "doc_id", "n", "label", "sketch", "lowest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides = None, ([], [])

        def done() -> Iterator[pa.RecordBatch]:
            left, right = sides
            if current is not None and (current[1] == current[2] or right):
                for a, b in _near(left, right or None, percent, current[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(b % 16)], ["a", "b", "chunk"])

        for batch in batches:
            for sig, i, j, second, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (sig, i, j) != current:
                    yield from done()
                    current, sides = (sig, i, j), ([], [])
                sides[second].append(tuple(row))
        yield from done()

    return rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(run, "a long, b long, chunk long")


def _compared(pairs: DataFrame, contents: DataFrame, same: Callable, made: Callable) -> DataFrame:
    """The pairs (a, b, chunk) for which same(made(content of a), made(content of b)), from contents (doc_id, size, content).

    Contents of a meet those of its partners in parts of bounded size, one part after the other, one row at a time. Both
    are found by one join, so contents are shuffled to it once.
    """
    partner = pairs.select("a", "chunk", "b", F.col("b").alias("doc_id"))
    leader = pairs.select("a", "chunk").distinct().select("a", "chunk", F.lit(None).cast("long").alias("b"), F.col("a").alias("doc_id"))
    met = partner.unionByName(leader).join(contents, "doc_id").select("a", "chunk", "b", "size", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, None
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for a, chunk, b, size, content in zip(*(c.to_pylist() for c in batch.columns)):
                if b is None:
                    current, own = a, made(size, content)
                elif a == current and same(own, made(size, content)):
                    found.append((a, b, chunk))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["a", "b", "chunk"])

    together = met.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return together.mapInArrow(run, "a long, b long, chunk long")


def _verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets of word shingles are linked: by sketches first, which never lose a link, then word by word."""

    def near(x: tuple, y: tuple) -> bool:
        (n, bits), (m, other) = x, y
        while len(bits) > len(other):
            bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
        while len(other) > len(bits):
            other = other[: len(other) // 2] ^ other[len(other) // 2 :]
        return int(np.bitwise_count(bits ^ other).sum()) <= allowed(min(n, m), percent)

    def grams(_: int, text: bytes) -> set:
        w = text.translate(_TABLE).split()
        return set(zip(*(w[j:] for j in range(words)))) if len(w) >= words else {tuple(w)} if w else set()

    def linked(own: set, other: set) -> bool:
        both = len(own & other)
        return 100 * both >= percent * (len(own) + len(other) - both)

    close = stored(_compared(pairs, sketches.withColumnRenamed("sketch", "content"), near, lambda n, s: (n, np.frombuffer(s, np.uint64))))
    ids = close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    whole = _mostly(texts, ids).select("doc_id", F.lit(0).cast("long").alias("size"), F.encode("text", "UTF-8").alias("content"))
    return _compared(close, whole, linked, grams).select("a", "b")


def _mostly(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows without most of those whose value in the column of ids (doc_id, sig) is not in ids, by a bitmap; a join must follow.

    So hardly a row that the join does not need is shuffled. The bitmap has eight bits or more an id and at most
    2**_MOST_BITS (32 MB); for more ids than it can tell apart the rows are joined with them instead.
    """
    ids, (on,) = stored(ids), ids.columns
    n = ids.count()
    if n > 1 << (_MOST_BITS - 1):
        return rows.join(ids, on, "left_semi").select(*rows.columns)
    size = 1 << min(max(_LEAST_BITS, (8 * n).bit_length()), _MOST_BITS)
    bit = f"pmod(xxhash64({on}), {size})"
    words = ids.select(F.expr(f"{bit} div 63").alias("word"), F.expr(f"shiftleft(1L, cast({bit} % 63 as int))").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    table = np.zeros(size // 63 + 1, np.int64)
    found = words.toArrow()  # of bounded size, so it may go through the driver
    table[found.column(0).to_numpy()] = found.column(1).to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            yield batch.filter(pa.array((shared.value[at // 63] >> (at % 63)) & 1 == 1))

    marked = rows.withColumn("_bit", F.expr(bit))
    return marked.mapInArrow(run, marked.schema).drop("_bit")


def jaccard_classes(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, from columns doc_id and text (others are ignored).

    Two documents link when 100 * intersection >= percent * union of their sets of word n-grams (A-Z lower-cased,
    words between ASCII white space; a text of fewer words is one n-gram). component_id is the smallest doc_id
    reachable by links. A null, empty or blank text has an empty set, size 0, and links with nothing; equal rows are
    copies of each other and each returned; a null doc_id links with nothing and keeps a null component. An empty
    table gives an empty result.
    """
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    stats = stored(_set_stats(docs, words))
    sets = stored(stats.where("n > 0 and doc_id is not null").groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("doc_id")))
    bands = {r.band: (r.sets, r.size) for r in sets.where("n > 1").groupBy(F.floor(F.log2("n")).alias("band")).agg(F.count("*").alias("sets"), F.avg("n").alias("size")).collect()}
    labels = None
    if bands:
        schemes = allocate({int(b): v for b, v in bands.items()}, percent, _met(stats))
        rows = _signature_rows(docs.where("doc_id is not null"), words, percent, schemes)
        buckets = stored(_shared_buckets(rows))
        members = stored(_members(buckets, sets))
        dropped(buckets)
        labels = _linked(docs, members, words, percent)
    found = sets
    if labels is not None:
        found = stored(sets.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("n", "fp1", "fp2", F.coalesce("component", "doc_id").alias("component")))
    else:
        found = sets.select("n", "fp1", "fp2", F.col("doc_id").alias("component"))
    alone = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return stats.join(found, ["n", "fp1", "fp2"], "left").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of documents but for near-duplicates: of each class the rows of its smallest doc_id, with the columns of documents.

    Rows of one doc_id stay or go together; of those that stay, rows of equal text are one (the one whose other columns
    have the smallest hash) and other texts under the same id stay too. Rows of a null doc_id and texts without words
    all stay; an empty table gives an empty result; columns may have any names.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc, text = plain.columns[names.index("doc_id")], plain.columns[names.index("text")]
    classes = jaccard_classes(plain.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), words, percent)
    stay = classes.where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    rows = plain.withColumn("_id", F.col(doc).cast("long"))
    rest = F.to_json(F.struct(*[c for c in plain.columns if c != text]))
    same = Window.partitionBy("_id", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)).orderBy(F.xxhash64(rest))
    first = rows.join(stay, "_id", "left_semi").withColumn("_n", F.row_number().over(same)).where("_n = 1").select(*plain.columns)
    return first.unionByName(rows.where("_id is null").select(*plain.columns)).toDF(*names)


def _linked(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame | None:
    """(id, component) of all sets that link with another one, from the rows (sig, doc_id, n) of shared buckets."""
    every, ids = members, stored(members.select("doc_id").distinct())
    if ids.isEmpty():
        return None
    texts = stored(_mostly(docs, ids))  # with a few others, which no pair names
    sketches = stored(_sketches(texts, words))
    labels, done = None, None
    for turn in range(_LEADERS):
        known = members.withColumn("label", F.col("doc_id")) if labels is None else _open(members, labels)
        members = known.select("sig", "doc_id", "n")  # a bucket of one component stays one
        pairs = _leader_pairs(known, percent, F.col("doc_id") if labels is None else F.xxhash64("doc_id", F.lit(turn)))
        pairs = stored(pairs if done is None else _without(pairs, done))
        links = _verified(pairs, texts, sketches, words, percent)
        labels = components(links) if labels is None else _merged(labels, stored(links))
        done = pairs.select("a", "b") if done is None else stored(done.unionByName(pairs.select("a", "b")))
    known = _open(members, labels)
    lowest = known.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, _LOWEST).alias("lowest"))
    large = known.where(F.col("size") > _FEW)
    large = stored(large.join(sketches.select("doc_id", "sketch"), "doc_id").join(lowest, "doc_id").select("sig", "doc_id", "n", "label", "sketch", "lowest", "size"))
    more = _few_pairs(known.where(F.col("size") <= _FEW), percent).unionByName(_near_pairs(large, percent))
    more = stored(_without(more.groupBy("a", "b").agg(F.min("chunk").alias("chunk")), done))
    links = stored(_verified(more, texts, sketches, words, percent))
    dropped(every, known, large, texts, sketches)
    return _merged(labels, links)


def _without(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """pairs (a, b, ...) but for those that done (a, b) has, either way round."""
    told = done.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return pairs.join(told, (F.least("a", "b") == F.col("lo")) & (F.greatest("a", "b") == F.col("hi")), "left_anti")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, doc_id, n, label, size): the members of buckets that hold more than one component."""
    known = stored(members.join(labels.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").select("sig", "doc_id", "n", F.coalesce("component", "doc_id").alias("label")))
    open_ = stored(known.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo <> hi and size > 2").select("sig", "size"))
    return stored(_mostly(known, open_.select("sig")).join(open_, "sig").select("sig", "doc_id", "n", "label", "size"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (id, component) after further links (a, b)."""
    if links.isEmpty():
        return labels
    by = lambda c, d: labels.select(F.col("id").alias(c), F.col("component").alias(d))
    between = stored(links.join(by("a", "ca"), "a", "left").select(F.coalesce("ca", "a").alias("a"), "b"))
    joined = components(between.join(by("b", "cb"), "b", "left").select("a", F.coalesce("cb", "b").alias("b")))
    moved = labels.join(joined.select(F.col("id").alias("component"), F.col("component").alias("above")), "component", "left").select("id", F.coalesce("above", "component").alias("component"))
    return stored(moved.unionByName(joined).distinct())
