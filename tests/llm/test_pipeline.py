import base64
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers as P
import tiktoken
from partwise.llm import mixing, rule_classifier
from test_ngram_join import brute


def test_run_matches_a_brute_force_version(spark, sf_small):
    """Near duplicates by all pairs, the mix by another engine's SQL, ids by another library; of the classifier, its labels."""
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = [r.doc_id for r in rule_classifier.scored(docs, labels).where("predicted = 1").collect()]
    quality = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    right = [(d in set(good)) == bool(q) for d, q in quality.items() if d in texts]
    assert sum(right) >= 0.95 * len(right)
    classes = brute([(d, texts[d]) for d in good])
    alone = sorted(d for d, (_, c) in classes.items() if c == d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet') WHERE doc_id IN ({','.join(map(str, alone))})")
    mixed = {d: (taken, size) for d, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.run(spark, sf_small).collect()
    assert Counter(r.doc_id for r in rows) == Counter({d: t // n for d, (t, n) in mixed.items() if n and t})
    assert all(list(r.ids) == library.encode_ordinary(texts[r.doc_id]) for r in rows)


def test_near_duplicates_leaves_no_table_of_texts_behind(spark, sf_small):
    from partwise.llm import _batches

    first = len(_batches._WRITTEN)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    left = corpus_pipeline.near_duplicates(spark, docs, sf_small)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [p for p in _batches._WRITTEN[first:] if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    assert paths and not any({"text", "sketch"} & set(spark.read.parquet(p).columns) for p in paths)
    classes = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id for r in left.select("doc_id").collect()} == {d for d, (_, c) in classes.items() if c == d}
