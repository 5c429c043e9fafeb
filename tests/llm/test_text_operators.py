import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from partwise.llm import byte_bpe, id_planes, lattice_lm, license_scan, media_columns, metric_join, mixing, rule_classifier
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BPE, WORDS, PIECES = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, source string, size int, key string, h int, label string, word string, block int, ids string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = {
    1: "The MIT License applies here. The mit-license twice.", 2: None, 3: "", 4: " \t\n ", 5: "a", 6: "word " * 3000, 7: "The MIT License applies here. The mit-license twice.",
    8: "日本語 テスト　全角 空白 é́ ñ", 9: "x" * 5000, 10: "it's we'll I'd 123 45.6!!  \n\n end \x85 odd", 11: "GNU   General\nPublic License; CC BY 4.0 CC BY", 12: "<|endoftext|> plain\\ text",
    13: "Lisenced under the Apache Licence, version 2.0", None: "no id at all",
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i in (5, None) else f"s{(i or 0) % 3}", 1, "k", 2, "l", "w", 3, "i") for i, t in TEXTS.items()]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_perfect_hash_has_one_slot_for_each_key():
    keys = [b"k%d" % i for i in range(5000)]
    table = byte_bpe.PerfectHash(keys)
    assert len(table.keys) == len(keys) and [table.get(k) for k in keys] == list(range(5000)) and table.get(b"other") == -1


def test_byte_bpe_equals_tiktoken_and_decodes(docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(docs, BPE, P.PATTERN), BPE, P.PATTERN).collect()
    assert len(found) == len(TEXTS) + 1
    for r in found:
        text = TEXTS[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    digest = by_id(byte_bpe.round_trip_digests(docs, BPE, P.PATTERN))
    assert digest[3].ids_sha256 == hashlib.sha256(b"").hexdigest() and digest[3].n_tokens == 0
    assert byte_bpe.round_trip_digests(empty, BPE, P.PATTERN).collect() == []


def test_id_planes_round_trip(docs, empty, spark, tmp_path):
    for n in (0, 1, 7, 65536, 65537):
        ids = np.random.default_rng(n).integers(0, 1 << 31, n).astype("<u4")
        assert all((id_planes.unpack(id_planes.pack(ids, bits=b)) == ids).all() for b in (False, True))
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    path = str(tmp_path / "ids")
    id_planes.write_ids(docs, path, WORDS, end_id=2, shards=3, chunk_ids=500, bits=True)
    rows = sorted(id_planes.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([*TEXTS, 1], key=lambda d: -1 if d is None else d)
    start = 0
    for r in rows:
        want = [*library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, list(r.ids)) == (start, len(want), want)
        start += len(want)
    assert id_planes.written_digests(empty, WORDS, 2).collect() == []


def test_written_digests_equal_the_library_by_default(docs, spark):
    library = Tokenizer.from_file(WORDS)
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    texts = {100 + i: t for i, t in enumerate(["a <|endoftext|> b", "a<|endoftext|>b", "x<|startoftext|><|endoftext|>y \n<|EndOfText|>", "<|endoftext|>\u0301e"])}
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    found = sorted(id_planes.written_digests(rows, WORDS, 2).collect(), key=lambda r: r.start)
    assert len(found) == len(TEXTS) + 1 + len(texts)
    start = 0
    for r in found:
        want = np.array([*library.encode({**TEXTS, **texts}[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_license_scan_base_and_fuzzy(docs, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = by_id(license_scan.license_rows(docs))
    for i, text in TEXTS.items():
        w = word.findall((text or "").translate(LOWER))
        places = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert found[13].labels == "apache-2.0-notice" and 0 < found[13].score < 1 and found[13].hits[0].edits == 3
    assert license_scan.license_rows(empty).collect() == []


def test_every_notice_is_found_with_its_allowed_errors():
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES)
    rng = np.random.default_rng(2)
    for notice, label in license_scan.NOTICES.items():
        k = license_scan.allowed_errors(notice)
        text = list(notice)
        for at in rng.choice(np.arange(1, len(text) - 1), k, replace=False):
            text[at] = "q"
        (_, _, hits), = scanner.scan(pa.array(["before, " + "".join(text) + " - after"]))
        assert label in {h[0] for h in hits}


def test_worse_notices_before_the_best_are_hits_too():
    good, bad = "released under the mit license", "released under teh mit license"
    scanner = license_scan.Scanner({}, {good: "mit-notice"})
    for said in ([bad, good], [good, bad], [bad, bad, good, bad], [good, good]):
        (_, _, hits), = scanner.scan(pa.array([" y ".join(said)]))
        assert [(h[1], h[3] > 0) for h in hits] == [(6 * k, s == bad) for k, s in enumerate(said)]


def test_media_columns(docs, empty):
    found = by_id(media_columns.document_media(docs))
    for i, text in TEXTS.items():
        raw = (text or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        r = found[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r.media_sha256 == hashlib.sha256(media_columns.stored_form(payload)).hexdigest()
    assert found[1].feature == found[7].feature
    assert media_columns.document_media(empty).collect() == []


def test_interleaved_sequence_keeps_order_and_captions():
    page = '<p>one<script>x</script> two</p><figure><img src="media:d1" alt="a"><figcaption>cap &amp; tion</figcaption></figure>three<img src="u"><br>four'
    parts = media_columns.sequence(page)
    assert [(p["kind"], p["text"] or p["caption"]) for p in parts] == [("text", "one two"), ("media", "cap & tion"), ("text", "three"), ("media", None), ("text", "four")]
    assert parts[1]["digest"] == "d1" and [p["position"] for p in parts] == list(range(5)) and media_columns.sequence(None) == []


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>x</title><body>one<img src=u>two", ["one", None, "two"]),
    ("<html><head><title>x</title><meta charset=utf-8><p>one<p>two", ["one", "two"]),
    ("<head><title>x</title><noscript><img src=u></noscript><style>a</style></head>one", [None, "one"]),
    ("<head>\n<script>x</script>\none", ["one"]),
    ("<head><title>x</title></head><svg><title>y</title></svg>one", ["yone"]),
    ("<figure><img src=u><figcaption>cap</figure>one<p>two", ["cap", "one", "two"]),
    ("<figure><img src=u><figcaption>cap</figcaption>", ["cap"]),
    ("one<figcaption>cap</figcaption>two", ["one", "cap", "two"]),
    ("one<figure>two<figcaption>cap</figcaption><p>three</figure>four", ["one", "two", "cap", "three", "four"]),
    ("<img src=u><figure><figure><img src=v><figcaption>in</figcaption></figure><img src=w><figcaption>out</figcaption></figure></figure>one", [None, "in", "out", "one"]),
])
def test_interleaved_sequence_keeps_all_text_of_pages_without_end_tags(page, want):
    assert [p["text"] or p["caption"] for p in media_columns.sequence(page)] == want


def test_mixing_matches_brute_force(docs, empty):
    rows = mixing.mix(docs).collect()
    size = Counter()
    for i, t in [*TEXTS.items(), (1, TEXTS[1])]:
        size[None if i in (5, None) else f"s{i % 3}"] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target, weight = {}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    rest, open_ = 1.5 * sum(size.values()), set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]} or open_
        for s in full:
            target[s] = 2.0 * size[s] if full is not open_ or level * weight[s] > 2 * size[s] else level * weight[s]
        rest, open_ = rest - sum(target[s] for s in full), open_ - full
    for r in rows:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source]) and 0 <= r.taken <= 2 * r.size
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []
    mixed = Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    assert all(mixed[r.doc_id] * r.size == r.taken * (2 if r.doc_id == 1 else 1) for r in rows)
    assert mixing.mixed_rows(docs).columns == docs.columns


@pytest.mark.parametrize("sizes", [[100] * 6, [250, 100, 50, 250, 100, 50], [30, 90, 90, 30, 90, 90, 30], [0, 0, 7]])
def test_mixing_of_tied_sources_matches_brute_force(spark, sizes):
    docs = spark.createDataFrame([(f"+s{k}", f"s{k}", n) for k, n in enumerate(sizes)], "key string, source string, size long")
    weight = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    want: dict[int, float] = {}
    rest, open_ = 1.5 * sum(sizes), set(range(len(sizes)))
    while open_:
        level = rest / sum(weight[k] for k in open_)
        full = {k for k in open_ if level * weight[k] > 2 * sizes[k]}
        want |= {k: 2.0 * sizes[k] if k in full else level * weight[k] for k in full or open_}
        rest, open_ = rest - sum(2.0 * sizes[k] for k in full), open_ - (full or open_)
    found = {int(r.key[2:]): r.target for r in mixing.source_targets(docs).collect()}
    assert all(math.isclose(found[k], want[k], abs_tol=1e-9) for k in want) and math.isclose(sum(found.values()), 1.5 * sum(sizes), abs_tol=1e-9)


def test_mixing_comes_near_its_targets(spark, sf_small):
    rows = mixing.mix(spark.read.parquet(f"{sf_small}/documents.parquet")).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_lattice_probabilities_match_enumeration():
    names = sorted([b"\0", b"\0a", b"ab", b"a", b"b", b"abc", b"c", b"\0ab"])
    weights = np.log(np.arange(1, len(names) + 1) / 40)
    lattice = lattice_lm.Lattice(names, weights)
    value = dict(zip(names, weights))

    def every(word):
        return [()] if not word else [(word[:k], *rest) for k in range(1, len(word) + 1) if word[:k] in value for rest in every(word[k:])]

    words = ["abc", "a", "", "cab", "abcabc", "a" * 70]
    got = lattice.log_probability(pa.array([w.encode() for w in words], pa.binary()))
    for w, g in zip(words[:5], got):
        assert math.isclose(g, np.logaddexp.reduce([sum(value[p] for p in cut) for cut in every(b"\0" + w.encode())]))
    assert np.isfinite(got[5])
    uses = lattice.expected(pa.array([b"abc"], pa.binary()), np.array([2]))
    cuts = every(b"\0abc")
    share = np.exp([sum(value[p] for p in c) for c in cuts])
    want = [2 * sum(s * c.count(n) for s, c in zip(share, cuts)) / share.sum() for n in names]
    assert np.allclose(uses, want)


def test_lattice_expected_uses_of_long_words():
    names, weights = lattice_lm.piece_weights(PIECES)
    lattice = lattice_lm.Lattice(names, weights)
    thai, short = "สวัสดีครับ" * 3, "สวัสดีครับ" * 2
    words = [w.encode() for w in (short, thai, "http://example.org/" + "a/b" * 30, "x" * lattice_lm._LONG, "x" * (lattice_lm._LONG + 1))]
    length = np.array([len(n) for n in names])
    for w in words:
        uses = lattice.expected(pa.array([w], pa.binary()), np.array([3]))
        assert math.isclose(uses @ length, 3 * (len(w) + 1), rel_tol=1e-9)
    before, lattice_lm._LONG = lattice_lm._LONG, 10
    try:
        one_by_one = lattice.expected(pa.array(words, pa.binary()), np.arange(1, 6))
        lattice_lm._LONG = 1000
        assert np.allclose(one_by_one, lattice.expected(pa.array(words, pa.binary()), np.arange(1, 6)))
    finally:
        lattice_lm._LONG = before


def test_language_model_learns_from_long_words(spark):
    sentence = "วันนี้อากาศดีมากเราไปเดินเล่นกัน"
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:20]
    score = lambda t: by_id(lattice_lm.score_documents(spark.createDataFrame([(held, sentence[:-3]), *((i, t) for i in train)], "doc_id long, text string"), PIECES))[held].score
    assert score(sentence * 2) > score("x") + 1


def test_language_model_counts_and_base(docs, empty):
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(x for i, t in [*TEXTS.items(), (1, TEXTS[1])] if not held(i) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    rows = lattice_lm.score_documents(docs, PIECES).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        t = tokens(TEXTS[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(counts[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9) and -1e9 < r.score < 0
    assert lattice_lm.score_documents(empty, PIECES).collect() == []


def test_classifier_separates_and_handles_no_labels(docs, empty, spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    found = {r.doc_id: r for r in rule_classifier.scored(spark.read.parquet(f"{sf_small}/documents.parquet"), labels).collect()}
    marks = [(found[r.doc_id].predicted, r.quality) for r in labels.collect()]
    assert sum(a == b for a, b in marks) / len(marks) > 0.9
    rows = rule_classifier.scored(docs, labels.limit(0)).collect()
    assert len(rows) == len(TEXTS) + 1 and all(r.score == 0.5 and r.predicted == 0 for r in rows)
    assert rule_classifier.scored(empty, labels).collect() == [] and rule_classifier.kept(docs, labels).columns == docs.columns


def test_lasso_keeps_the_rule_that_matters():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = (x[:, 2] > 0.6).astype(float)
    intercept, rules = rule_classifier.fit(x, y)
    score = intercept + sum(w * rule_classifier.holds(r, x) for r, w in rules)
    assert ((score > 0) == y).mean() > 0.97 and len(rules) < 40


def test_metric_join_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 8))
    rows = [(i, (base[i % 30] + rng.normal(size=8) * (0.0 if i % 7 == 0 else 0.2)).tolist(), int(i % 3 > 0), "x") for i in range(200)]
    bad = [(900, None, 1, ""), (901, [0.0] * 8, 1, ""), (902, [float("nan")] * 8, 1, ""), (903, [1.0, None] * 4, 1, ""), (904, [1.0] * 8, None, ""), (905, [], 1, ""), (906, [1.0] * 4, 1, ""), (None, [1.0] * 8, 1, "")]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, label int, cell string")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    lab = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (lab[:, None] == lab)
    np.fill_diagonal(near, False)
    comp = list(range(len(rows)))
    for _ in rows:
        comp = [min([comp[i], *(comp[j] for j in np.flatnonzero(near[i]))]) for i in range(len(rows))]
    for cell in (2048, 16):
        found = {r.vec_id: r for r in metric_join.near_duplicates(df, cell=cell).collect()}
        assert len(found) == len(rows) + len(bad)
        for i in range(len(rows)):
            assert (found[i].n_links, found[i].component_id, found[i].kept) == (near[i].sum(), comp[i], comp[i] == i)
        assert all(found[b[0]].n_links == 0 and found[b[0]].component_id == b[0] for b in bad)
    assert metric_join.near_duplicates(df.limit(0)).collect() == []


def test_metric_join_keeps_a_path_whose_links_are_nobodys_smallest(spark):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]  # noqa: E731  links: 21 degrees at most
    angles = {3: 0, 5: 20, 6: 40, 2: 60, 9: 80, 1: 100, 50: 140}
    df = spark.createDataFrame([(i, at(a), 0) for i, a in angles.items()], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in metric_join.near_duplicates(df).collect()}
    assert found == {3: (1, 1), 5: (2, 1), 6: (2, 1), 2: (2, 1), 9: (2, 1), 1: (1, 1), 50: (0, 50)}


def test_pivots_of_the_given_labels_replicate_and_prune(spark, sf_small):
    rows = spark.read.parquet(sf_small.replace("sf0.001", "sf0.01") + "/embeddings.parquet")
    classes = rows.where("label is not null").select(F.concat_ws("|", F.col("label").cast("string"), F.size("embedding").cast("string")).alias("group"), F.col("embedding").cast("array<double>").alias("v"), F.col("vec_id").cast("long").alias("id"), F.lit(1).cast("long").alias("times"))
    clustered = spark.createDataFrame([("c|8", [float(j == i % 6) + 0.01 * ((i * 7 + j) % 5) for j in range(8)], 10**6 + i, 1) for i in range(120)], "group string, v array<double>, id long, times long")
    radius = math.sqrt(2 - 2 * metric_join.COSINE)
    sent = metric_join.replicated(classes.unionByName(clustered), radius)
    cells = sent.groupBy(F.regexp_extract("cell", r"^(.*)\|\d+$", 1).alias("group"), "cell").agg(F.count("*").alias("sent"), F.count_if("home").alias("homes"))
    told = {r.group: r for r in cells.groupBy("group").agg(F.count("*").alias("cells"), F.sum("homes").alias("n"), F.sum("sent").alias("sent"), F.sum(F.col("homes") * F.col("sent")).alias("pairs")).collect()}
    for group in told.values():
        assert group.cells == 1 if group.n <= metric_join.FEW else group.cells > 1
        assert group.n <= group.sent <= group.n * group.cells and group.pairs <= group.n**2
    assert told["c|8"].pairs < 0.3 * told["c|8"].n ** 2 and told["c|8"].sent < 2 * told["c|8"].n


def test_long_lists_of_notices_take_time_in_proportion():
    import random
    import time

    rng, notices = random.Random(8), list(license_scan.NOTICES)

    def edited(text):
        chars = list(text)
        for _ in range(3):
            chars[rng.randrange(len(chars))] = rng.choice("abcdefgh")
        return "".join(chars)

    scanner, began = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES), time.time()
    listed = [edited(rng.choice(notices)) for _ in range(1500)]
    (_, _, hits), (_, base, none) = scanner.scan(pa.array([" ".join(listed), "general public license " * 5000]))
    assert time.time() - began < 30 and len(hits) > 1000 and base == [] and none == []
    assert all(a[2] <= b[1] for label in set(license_scan.NOTICES.values()) if list(license_scan.NOTICES.values()).count(label) == 1 for own in [[h for h in hits if h[0] == label]] for a, b in zip(own, own[1:]))
