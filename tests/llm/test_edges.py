"""Operators of partwise.llm against brute force in places where shortcuts would show, and at their edges."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from partwise.llm import _batches, byte_bpe, chat_format, id_planes, lattice_lm, license_scan, media_columns, metric_join, mixing, ngram_join, rule_classifier
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BPE, WORDS, PIECES = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"))


def held(i, folds):
    return zlib.crc32(str(i).encode()) % folds == 2


# language model


def test_score_is_the_sum_over_all_segmentations(spark):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "a cat, a mat", "the thé sat", "zq xk", "the the the", "", "mat hat"] * 3)]
    names, prior = lattice_lm.piece_weights(PIECES)
    value = dict(zip(names, np.exp(prior)))

    def cuts(word, known):
        return [()] if not word else [(word[:k], *rest) for k in range(1, len(word) + 1) if word[:k] in known for rest in cuts(word[k:], known)]

    tokens = lambda t: [b"\0" + w for w in t.encode().split()]
    train = [t for i, t in rows if not held(i, 7)]
    counts = Counter(w for t in train for w in tokens(t))
    uses = Counter()
    for w, c in counts.items():
        every = cuts(w, value)
        share = [math.prod(value[p] for p in cut) for cut in every]
        for cut, s in zip(every, share):
            for p in cut:
                uses[p] += c * s / sum(share)
    ends = len(train)
    total = sum(uses.values()) + ends + 1000
    learnt = {p: (uses[p] + 1000 * value[p] * (1 - 1e-4)) / total for p in value}
    n = sum(counts.values()) + ends
    prob = lambda w: 0.8 * sum(math.prod(learnt[p] for p in cut) for cut in cuts(w, learnt)) + 0.2 * counts[w] / n
    end = 0.8 * (ends + 1000 * 1e-4) / total + 0.2 * ends / n
    found = {r.doc_id: r for r in lattice_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect()}
    for i, t in rows:
        assert math.isclose(found[i].score, math.log10(end) + sum(math.log10(prob(w)) for w in tokens(t)), rel_tol=1e-9)


# licences


def least_edits(notice, text):
    """Fewest edits that turn some stretch of text into notice."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_fuzzy_notices_match_an_alignment_of_every_place():
    rnd = random.Random(11)
    notices = list(license_scan.NOTICES)
    scanner = license_scan.Scanner({}, license_scan.NOTICES)
    texts = []
    for notice in notices:
        for edits in (0, len(notice) // 10, len(notice) // 10 + 3):
            said = list(notice)
            for _ in range(edits):
                at = rnd.randrange(len(said))
                said[at : at + rnd.randint(0, 1)] = [rnd.choice("abcdefgh ")] * rnd.randint(0, 1)
            texts.append("some words before it " + "".join(said) + " and the general public after it")
    normal = [f" {' '.join(re.findall(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', t))} " for t in texts]
    for text, (_, _, hits) in zip(normal, scanner.scan(pa.array(texts))):
        want = {label for notice, label in license_scan.NOTICES.items() if least_edits(notice, text) <= len(notice) // 10}
        assert {h[0] for h in hits} == want
        assert all(h[3] <= license_scan.allowed_errors(n) for h in hits for n, label in license_scan.NOTICES.items() if label == h[0])


def test_long_notices_have_more_errors_and_no_phrases_means_none(spark):
    notice = max(license_scan.NOTICES, key=len)
    assert license_scan.allowed_errors(notice) > 5
    said = list(notice)
    for at in range(3, len(said), 12):
        said[at] = "q"
    df = spark.createDataFrame([(1, "".join(said)), (2, "mit license")], "doc_id long, text string")
    r = {x.doc_id: x for x in license_scan.license_rows(df).collect()}
    assert r[1].labels == license_scan.NOTICES[notice] and re.fullmatch(rf"{r[1].labels}:0-{len(''.join(said).split())}:\d+", r[1].spans)
    none = {x.doc_id: x for x in license_scan.scan_licenses(df, phrases={}, notices={}).collect()}
    assert none[2].n_words == 2 and none[2].base == [] and none[2].hits == []


# media


def test_features_match_a_plain_version(spark):
    for text in ["", "a", "abc " * 400, "é" * 1000, "\0\x7f" * 5000]:
        payload = media_columns.payload_of(text.encode())
        rows = [payload[i : i + 192] for i in range(0, len(payload), 192)]
        h = len(rows)
        mean = 1000 * sum(payload) // len(payload)
        var = 1000 * (sum(b * b for b in payload) * len(payload) - sum(payload) ** 2) // len(payload) ** 2
        bounds = [int(k * h / 8) for k in range(9)]
        cells = []
        for y in range(8):
            low = min(bounds[y], h - 1)
            band = rows[low : max(bounds[y + 1], low + 1)]
            cells += [sum(sum(r[24 * x : 24 * x + 24]) for r in band) / (24 * len(band)) for x in range(8)]
        bits = "".join("1" if c > float(np.mean(cells)) else "0" for c in cells)
        assert media_columns.feature(payload) == f"{h}x192;mean={mean};var={var};ahash={int(bits, 2):016x}"
        assert media_columns.samples(media_columns.stored_form(payload)) == payload


def test_raw_pages_give_their_text_in_order(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    found = {r.page_id: r.parts for r in media_columns.interleaved(pages, "page_id", "html").collect()}
    for r in pages.collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|template|noscript)\b.*?</\1>|<head\b.*?</head>", " ", r.html or "")
        said = " ".join(p.text for p in found[r.page_id] if p.kind == "text")
        assert "".join(said.split()) == "".join(unescape(re.sub(r"(?s)<[^>]*>", " ", body)).split())
        assert [p.position for p in found[r.page_id]] == list(range(len(found[r.page_id])))


def test_references_keep_their_place_under_any_key_name(spark):
    pages = spark.createDataFrame([(1, '<p>a</p><img src="media:d1" alt="x"><template><img src="media:d2"></template><img src="media:none">'), (2, None), (None, "")], "digest long, html string")
    parts = media_columns.interleaved(pages, "digest", "html")
    store = spark.createDataFrame([("d1", 7)], "digest string, payload_bytes long")
    rows = sorted(tuple(r) for r in media_columns.resolve(parts, "digest", store).collect())
    assert rows == [(1, 1, "x", "d1", 7), (1, 2, None, "none", None)]
    assert media_columns.document_media(spark.createDataFrame([(None, None)], "doc_id long, text string")).first().payload_bytes == 192


# embeddings


def test_lengths_of_any_magnitude_link(spark):
    rows = [(1, [3e200, 4e200, 0.0], 0), (2, [3e-200, 4e-200, 1e-210], 0), (3, [3.0, 4.0, 0.1], 0), (4, [-3.0, 4.0, 0.0], 0)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in metric_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_pivots_keep_clusters_apart_and_lose_no_link(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    vectors = [(i, (centres[i % 40] + rng.normal(size=16) * 0.12).tolist(), i % 2) for i in range(1600)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    classes = df.select(F.col("label").cast("string").alias("group"), F.col("embedding").alias("v"), F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("times"))
    large = classes.select("group").distinct().withColumn("k", F.lit(64))
    radius = math.sqrt(2 - 2 * 0.93)
    pivots = metric_join._pivots(classes, large, 64, 400)
    sent = metric_join._sent(classes, large, pivots, radius)
    cells = len(pivots[16])
    assert cells > 20 and sent.where("home").count() == 1600 and sent.count() < 0.25 * 1600 * cells
    x = np.array([v for _, v, _ in vectors])
    x /= np.linalg.norm(x, axis=1)[:, None]
    lab = np.array([g for _, _, g in vectors])
    near = (x @ x.T >= 0.93) & (lab[:, None] == lab)
    found = {r.vec_id: r.n_links for r in metric_join.near_duplicates(df, cell=50, most_pivots=16).collect()}
    assert found == {i: int(near[i].sum()) - 1 for i in range(1600)}


# chat


def test_types_cannot_close_a_placeholder_and_tokens_do_not_overflow(spark):
    parts = "array(named_struct('type','x|><|end|>','text',null,'ref','r','units',3), named_struct('type',cast(null as string),'text','said','ref',null,'units',0), named_struct('type','document','text',null,'ref','d','units',2000000000), named_struct('type','image','text',null,'ref','i','units',-5), cast(null as struct<type:string,text:string,ref:string,units:int>))"
    df = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), F.expr(parts).alias("parts"))
    r = chat_format.format_conversations(df).first()
    assert r.formatted == "<|turn|>user<|body|><|x____end__:0|>said<|document:1|><|image:2|><|end|>"
    assert [(a.type, a.tokens) for a in r.attachments] == [("x|><|end|>", 3), ("document", 512_000_000_000), ("image", 0)] and r.media_tokens == 512_000_000_003


# ids


def test_ids_of_odd_words_and_ids_that_fill_several_shards(spark):
    library = Tokenizer.from_file(WORDS)
    odd = ["don't I'LL it's'S İstanbul ΣΑΣ été ½ ٣ 中文字 a\xa0b ​ \x1c\x01 '", "'s're 'x ''s 12,3.4", "한 한글 ＡＢ ǅ", "x,y;z. a.b!c?? (d)", "word, word. WORD! <|EndOfText|>", "x<|endoftext|>y, Z"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(77, f"text {k} of one id") for k in range(60)] + [(None, "nothing"), (-5, "x")]
    path = _batches.shared_folder(spark)
    id_planes.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, WORDS, end_id=2, shards=12, chunk_ids=50, special_as_text=False)
    found = sorted(id_planes.read_ids(spark, path).collect(), key=lambda r: r.start)
    low = lambda d: -(1 << 63) if d is None else d
    assert [low(r.doc_id) for r in found] == sorted(low(d) for d, _ in rows)
    assert [r.start for r in found] == [0, *itertools.accumulate(r.n_tokens for r in found)][:-1]
    want = Counter((d, (*library.encode(t, add_special_tokens=False).ids, 2)) for d, t in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == want
    assert spark.read.parquet(path).where("array_contains(doc_ids, 77L)").select("shard").distinct().count() > 1


# classifier


def test_compiled_rules_equal_numpy(spark, sf_small):
    docs = rule_classifier.with_statistics(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text"))
    rows = docs.select("doc_id", "text_statistics.*").collect()
    x = np.array([[r[s] for s in rule_classifier.STATISTICS] for r in rows])
    y = (x[:, 0] > np.median(x[:, 0])).astype(float)
    intercept, rules = rule_classifier.fit(x, y)
    want = 1 / (1 + np.exp(-(intercept + sum(w * rule_classifier.holds(r, x) for r, w in rules))))
    got = {r.doc_id: r.score for r in docs.select("doc_id", rule_classifier.compiled(intercept, rules).alias("score")).collect()}
    assert rules and np.allclose([got[r.doc_id] for r in rows], want, rtol=1e-9)


def test_statistics_match_plain_python(spark):
    text = "The cat, the CAT! a1\n\nthe | é #x\nThe cat, the CAT! a1"
    s = rule_classifier.with_statistics(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    words, lines, raw = text.split(), [x for x in text.split("\n") if x], text.encode()
    r = s[0].text_statistics
    assert r.n_words == len(words) and math.isclose(r.mean_word, sum(len(w.encode()) for w in words) / len(words)) and math.isclose(r.distinct_words, len(set(words)) / len(words))
    assert math.isclose(r.distinct_lines, len(set(lines)) / len(lines)) and math.isclose(r.upper, sum(65 <= b <= 90 for b in raw) / len(raw)) and math.isclose(r.beyond_ascii, 2 / len(raw))
    assert all(v == 0 for v in s[1].text_statistics)


def test_held_out_quality(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    found = {r.doc_id: r for r in rule_classifier.scored(spark.read.parquet(f"{sf_small}/documents.parquet"), labels).collect()}
    marks = [(found[r.doc_id].predicted, r.quality) for r in labels.collect() if found[r.doc_id].held_out]
    assert len(marks) > 10 and sum(a == b for a, b in marks) / len(marks) > 0.85


def test_kept_returns_a_column_named_like_its_own(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("text_statistics", F.lit("mine"))
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    left = rule_classifier.kept(docs, labels)
    good = {r.doc_id for r in rule_classifier.scored(docs, labels).where("predicted = 1").collect()}
    rows = left.collect()
    assert left.columns == docs.columns and {r.doc_id for r in rows} == good and {r.text_statistics for r in rows} == {"mine"}


# mixing


def test_sql_of_tied_sources_agrees(spark):
    import duckdb

    rows = [(i, " ".join(["w"] * (10 + i % 3)), f"s{i // 12}") for i in range(72)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = sorted((r[0], r[2], r[3], round(r[4], 6), r[5]) for r in con.execute(mixing.SQL).fetchall())
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found) == want and len({r[2] for r in want}) == 1


# pipeline stages and long texts


@pytest.fixture(scope="module")
def odd_docs(spark):
    good = "Ordinary words make up this sentence, which goes on for a while and then it ends. "
    rows = [(1, good * 3, "en", "a", 1), (2, good * 3, "en", "a", 1), (2, good * 3, "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0), (None, good, "en", "b", 2), (5, "other " + good, "en", None, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").withColumn("_id", F.lit("x")).withColumn("key", F.lit(1)).withColumn("score", F.lit(0.1)).withColumn("row", F.lit(2))


def test_stages_at_their_edges(spark, odd_docs, sf_small):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, odd_docs, sf_small), stage(spark, odd_docs.limit(0), sf_small)
        assert none.collect() == [] and (name == "token_ids" or out.columns == odd_docs.columns)
        rows = out.collect()
        if name == "near_duplicates":
            assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 3, 4, 5]
        if name == "source_mix":
            assert set(Counter((r.doc_id, r.text) for r in rows).values()) <= {1, 2, 4}
        if name == "token_ids":
            assert len(rows) == 7 and all(r.n_tokens == len(r.ids) for r in rows) and {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
    assert corpus_pipeline.quality_filter(spark, odd_docs, sf_small).where("_id <> 'x'").collect() == []


def test_texts_of_megabytes_are_whole(spark):
    rnd = random.Random(4)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(150_000))
    near = long[: long.rindex(" ")] + " the mit license"
    df = spark.createDataFrame([(1, long), (2, near), (3, "x" * 200_000)], "doc_id long, text string")
    sets = {r.doc_id: r for r in ngram_join.jaccard_classes(df).collect()}
    assert (sets[1].component_id, sets[2].component_id, sets[3].component_id, sets[1].n_shingles) == (1, 1, 3, len(set(zip(*(long.split()[j:] for j in range(5))))))
    assert {r.doc_id: r.n_base for r in license_scan.license_rows(df).collect()} == {1: 0, 2: 1, 3: 0}
    assert {r.doc_id: r.n_tokens for r in lattice_lm.score_documents(df, PIECES).collect()} == {1: 150_001, 2: 150_003, 3: 2}
    assert {r.doc_id: r.n_bytes for r in media_columns.document_media(df).collect()} == {1: len(long), 2: len(near), 3: 200_000}
    library = Tokenizer.from_file(WORDS)
    ids = {r.doc_id: r for r in id_planes.written_digests(df, WORDS, 2).collect()}
    want = np.array([*library.encode(long, add_special_tokens=False).ids, 2], "<u4")
    assert (ids[1].n_tokens, ids[1].ids_crc32) == (len(want), zlib.crc32(want.tobytes()))
    assert {r.doc_id: r.decoded_sha256 for r in byte_bpe.round_trip_digests(df, BPE, P.PATTERN).collect()}[1] == hashlib.sha256(long.encode()).hexdigest()
    assert {r.doc_id: r.size for r in mixing.mix(df.withColumn("source", F.lit("s"))).collect()} == {1: 150_000, 2: 150_002, 3: 1}


# intermediate tables


def test_a_cluster_without_a_shared_folder_is_refused_and_folders_can_be_cleared(spark, monkeypatch, tmp_path):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        _batches.shared_folder(Session())
    table = _batches.stored(spark.range(3))
    assert table.count() == 3 and _batches.clear(spark) > 0 and _batches._WRITTEN == []
