"""The registered queries on the smallest tables, and the pipeline stage by stage against its parts."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from linkloom.llm import queries


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(map(str, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(str, r)) for r in cur.fetchall())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before), name
        if name == "secret_scan":
            assert set(after) == set(before) and all(r["n_chars"] == len(r["text"]) for r in after.values())
        docs, before = spark.createDataFrame(list(after.values()), docs.schema), after
    rows = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(rows) == set(before)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "decontamination", "secret_scan", "sentencepiece"]


def test_pipeline_against_brute_force(spark, sf_dir):
    """What each stage keeps of the small table, by plain Python over whole texts: shingle sets, windows and the library's ids."""
    import hashlib
    import re

    import public_tokenizers
    import sentencepiece

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    spoken = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, spoken, sf_dir).collect()}
    assert kept <= {d for d, t in docs.items() if any(map(str.isalpha, t))} and len(kept) >= 0.97 * len(docs)

    def shingles(t):
        w = re.findall("[^ \t-\r]+", low(t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    sets, root = {d: shingles(docs[d]) for d in kept}, {d: d for d in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(kept)
    for i, a in enumerate(order):
        for b in order[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {d for d in kept if find(d) == d}
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    windows = {tuple(w[i : i + min(10, len(w))]) for w in map(split, items) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    kept = {d for d in kept if not any(tuple(w[i : i + k]) in windows for w in [split(docs[d])] for k in sizes for i in range(len(w) - k + 1))}
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(rows) == kept
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [d for d in kept if "token" not in docs[d].lower() and not re.search("[A-Za-z0-9_+/.~-]{14}", docs[d])]
    assert len(plain) > 50 and all(rows[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, library.encode(docs[d]))).encode()).hexdigest() for d in plain)


def test_pipeline_of_an_empty_table_and_of_repeated_ids(spark, sf_dir):
    """Rows of one doc_id are judged each by its own text; columns that clash with names used inside stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prose = [r["text"] for r in docs.where("lang = 'en' and length(text) > 300").orderBy("doc_id").limit(40).collect()]
    odd = [(1, "en", prose[0], "a"), (1, "en", prose[1], "b"), (1, "en", "!!", "c"), (2, "en", prose[0], "d"), (2, None, None, "e")]
    given = spark.createDataFrame(odd + [(100 + i, "en", t, "x") for i, t in enumerate(prose[2:])], "doc_id long, lang string, text string, _number string").withColumn("n_chars", F.lit(0).cast("int"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given.limit(0), sf_dir).count() == 0, name
        given = spark.createDataFrame(stage(spark, given, sf_dir).collect(), given.schema)
        if name == "language_id":
            assert sorted(r["_number"] for r in given.where("doc_id <= 2").collect()) == ["a", "b", "d"]
        if name == "minhash_near_dedup":
            assert sorted(r["_number"] for r in given.where("doc_id <= 2").collect()) == ["a", "b"]
    assert given.columns == ["doc_id", "lang", "text", "_number", "n_chars"]


def test_pipeline_without_doc_ids(spark, sf_dir):
    """Documents whose doc_id is null are kept, dropped and masked as they would be with one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 5000")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("size(split(text, ' ')) >= 12").first()["text"]
    prose = max((r["text"] for r in docs.collect()), key=len)
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    texts = [prose, prose, f"{prose} {item}", "!!", f'token = "{key}" {prose}']
    bare = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    both = docs.where(docs["text"] != prose).withColumn("lang", F.coalesce("lang", F.lit("en"))).unionByName(bare, allowMissingColumns=True)
    left = lambda stage, of: sorted(r["text"] for r in stage(spark, of, sf_dir).where("doc_id is null").collect())
    assert left(corpus_pipeline.language_stage, both) == sorted(t for t in texts if t != "!!")
    assert left(corpus_pipeline.benchmark_stage, both) == sorted(t for t in texts if item not in t)
    assert left(corpus_pipeline.secret_stage, both) == sorted(t.replace(key, "[SECRET]") for t in texts)
    assert left(corpus_pipeline.duplicate_stage, both).count(prose) <= 1 and "!!" in left(corpus_pipeline.duplicate_stage, both)
    assert left(corpus_pipeline.duplicate_stage, both.where("doc_id is null and length(text) > 2").limit(2)) == [prose]
