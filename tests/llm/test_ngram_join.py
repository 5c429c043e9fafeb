import random
from itertools import combinations

import numpy as np
from partwise.llm import ngram_join, ngram_sets

SCHEMA = "doc_id long, text string, component_id string, size int"


def brute(rows, words=5, percent=80):
    sets = {}
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        w = (text or "").translate(table).encode().split()
        sets[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def found(spark, rows, **more):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, **more).collect()}


def test_chains_copies_and_near_copies_match_brute_force(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, doc = [], 100
    for size in [1, 3, 4, 5, 6, 8, 9, 12, 20, 40, 90, 200, 400]:
        base = [rnd.choice(vocab) for _ in range(size)]
        for edits in [0, 0, 1, 1, 2, 3, 5, 8]:
            w = list(base)
            for _ in range(edits * max(1, size // 60)):
                k = rnd.randrange(len(w) + 1)
                w[k : k + rnd.randint(0, 1)] = [rnd.choice(vocab)] * rnd.randint(0, 1)
            rows.append((doc, " ".join(w).upper() if edits == 1 else "\n".join(w)))
            doc -= 1 if doc < 60 else 2
            doc = doc if all(doc != d for d, _ in rows) else 1000 + len(rows)
    rows += [(5001, None), (5002, ""), (5003, " \t\n"), (5004, "one"), (5005, "ONE")]
    assert found(spark, rows) == brute(rows)


def test_common_passage_does_not_join_others(spark):
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"q{rnd.randrange(10**6)}" for _ in range(rnd.randint(5, 60)))) for i in range(60)]
    rows += [(100 + i, rows[0][1] + f" tail{i}") for i in range(40)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_repeated_rows_and_null_ids(spark):
    assert found(spark, []) == {}
    df = spark.createDataFrame([(7, "a b c d e f", "", 0), (7, "a b c d e f", "", 0), (3, "a b c d e f", "", 0), (None, "a b c d e f", "", 0)], SCHEMA)
    rows = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df).collect())
    assert rows == [(-1, 2, None), (3, 2, 3), (7, 2, 3), (7, 2, 3)]


def test_sample_table_matches_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


def test_any_linked_pair_shares_a_signature_under_every_allocation():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 1.0):
        schemes = {b: ngram_sets.Scheme(b, s.segments if not share else max(2, s.segments * 2 // 3), int(share * s.segments)) for b, s in ngram_sets.allocate({b: (1, 1.5 * 2**b) for b in range(1, 9)}, 80).items()}
        for _ in range(300):
            n = int(rng.integers(4, 200))
            a = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            d = len(a) // 4
            drop = int(rng.integers(0, len(a) // 5 + 1))
            add = int(rng.integers(0, d + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 64, add, np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            rows = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
            owner, sigs = ngram_sets.signatures(rows, np.concatenate([a, b]), 2, schemes, 80)
            assert set(sigs[owner == 0].tolist()) & set(sigs[owner == 1].tolist())


def templated(count, seed):
    """Texts of which two fifths are one passage, so that many segments recur in all of them."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(24)]
    rows = []
    for i in range(count):
        own = [f"q{rnd.randrange(10**9)}" for _ in range(36)]
        rows.append((i, " ".join([*own[:12], *passage, *own[12:]])))
    return rows + [(count + k, t.replace("p3 ", "other ") if k % 2 else t + " end") for k, (_, t) in enumerate(rows[:6])]


def test_allocation_indexes_deletions_where_they_pay(spark):
    few, many = {5: (1000, 48.0)}, {5: (10**6, 48.0)}
    assert ngram_sets.allocate(few, 80)[5].deletions == 0 and ngram_sets.allocate(few, 80, {5: (0.1, 20.0)})[5].deletions == 0
    scheme = ngram_sets.allocate(many, 80, {5: (0.1, 200_000.0)})[5]
    assert scheme.deletions > 0 and scheme.segments < ngram_sets.allocate(few, 80)[5].segments
    measured, ngram_join._met = ngram_join._met, lambda stats: {b: (0.1, 1e6) for b in range(20)}
    try:
        rows = templated(120, 8)
        assert found(spark, rows) == brute(rows)
    finally:
        ngram_join._met = measured


def test_hot_signatures_and_open_buckets_are_split_without_loss(spark):
    before = ngram_join._HOT, ngram_join._BLOCK
    ngram_join._HOT, ngram_join._BLOCK = 4, 7
    try:
        rows = templated(150, 9) + [(1000 + i, f"a b c d e f g h i j k l m n o p q r s t u v w x y z {i}") for i in range(60)]
        assert found(spark, rows) == brute(rows)
    finally:
        ngram_join._HOT, ngram_join._BLOCK = before


def test_shingle_counts_do_not_rest_on_the_shortened_hash():
    text = " ".join(f"w{i % 50}" for i in range(4000)).encode()
    raw, at = np.frombuffer(text * 3, np.uint8), np.arange(4) * len(text)
    rows, hashes = ngram_sets.shingle_sets(raw, at, 5)
    assert np.bincount(rows).tolist() == [50, 50, 50] and len(set(zip(rows.tolist(), hashes.tolist()))) == 150


def test_one_of_each_keeps_other_texts_of_an_id_and_any_columns(spark):
    words = "one two three four five six seven"
    rows = [(1, words, "x", 0), (1, words, "y", 0), (1, "another text under the same id here", "z", 0), (2, words, "x", 0), (None, words, "x", 0), (3, None, "x", 0), (4, "", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, component_id int")
    left = ngram_join.one_of_each(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([(0, words), (1, words), (1, "another text under the same id here"), (3, ""), (4, "")])
    assert ngram_join.one_of_each(df.limit(0)).collect() == []


def test_signature_rows_are_narrow_and_names_that_agree_lose_no_link(spark):
    rows = templated(150, 9) + [(1000 + i, f"a b c d e f g h i j k l m n o p q r s t u v w x y z {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = ngram_join._HOT, ngram_join._KEY_BITS
    ngram_join._HOT = 4
    try:
        signed = ngram_join._signature_rows(df.coalesce(1), 5, 80, ngram_sets.allocate({b: (100, 1.5 * 2**b) for b in range(8)}, 80))
        assert signed.columns == ["sig", "key"]
        found_rows = signed.collect()
        assert all(r.sig & 0xFFFF == 0 and 0 <= r.key < 1 << 40 for r in found_rows)
        assert {r.sig & ngram_join._HOT_BIT for r in found_rows} == {0, ngram_join._HOT_BIT}
        for bits in (0, 2, 5):  # so many sets share a name
            ngram_join._KEY_BITS = bits
            assert found(spark, rows) == brute(rows)
    finally:
        ngram_join._HOT, ngram_join._KEY_BITS = before


def test_sketches_have_at_most_two_bits_an_element_and_never_hide_a_link(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(n))) for i, n in enumerate([5, 36, 68, 69, 132, 133, 260, 700, 1500])]
    sketched = ngram_join._sketches(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert all(8 * len(r.sketch) <= max(64, 2 * r.size) for r in sketched)
    for i, text in list(rows):
        w = text.split()
        rows += [(100 * i + k + 100, " ".join(w[: len(w) - len(w) // 6 * (k == 0)] + [f"x{k}y{j}" for j in range(len(w) // 6 * (k > 0))])) for k in range(2)]
    assert found(spark, rows) == brute(rows)


def test_few_members_meet_as_pairs_and_many_in_blocks_alike(spark):
    before = ngram_join._FEW
    rows = templated(60, 11)
    try:
        for few in (0, 8, 1000):
            ngram_join._FEW = few
            assert found(spark, rows) == brute(rows)
    finally:
        ngram_join._FEW = before


def test_tables_of_texts_go_once_they_are_read(spark):
    from partwise.llm import _batches

    first = len(_batches._WRITTEN)
    classes = ngram_join.jaccard_classes(spark.createDataFrame(templated(40, 12), "doc_id long, text string"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [p for p in _batches._WRITTEN[first:] if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    assert paths and not any({"text", "sketch"} & set(spark.read.parquet(p).columns) for p in paths)
    assert len(classes.collect()) == 46
