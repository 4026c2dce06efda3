"""Each stage on its own input, and the whole run."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    quality = dict(spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality").collect())
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert all(before[k] == row for k, row in after.items())
        seen[name] = before, after
    before, after = seen["language ID"]
    assert before.keys() == after.keys()
    before, after = seen["quality classifier"]
    wrong = sum((quality[k] == 1) != (k in after) for k in before if k in quality)
    assert wrong <= 0.05 * len(quality) and len(after) < len(before)
    before, after = seen["exact dedup"]
    last = {}
    for k, row in before.items():
        last[row.text.encode().lower()] = max(k, last.get(row.text.encode().lower(), k))
    assert set(after) == set(last.values())
    before, after = seen["SimHash near-dedup"]

    def shingles(text):
        words = text.encode().lower().split()
        return {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}

    sets = {k: shingles(row.text) for k, row in before.items()}
    for k in before.keys() - after.keys():
        assert max(len(sets[k] & s) / len(sets[k] | s) for j, s in sets.items() if j != k) >= 0.6

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    total = {}
    for piece in pieces:
        total[piece.doc_id] = total.get(piece.doc_id, 0) + piece.length
    assert total == {k: len(tokenizer.encode(row.text).ids) + 1 for k, row in after.items()}


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def tables(docs, labels, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_run_on_empty_tables(spark, small, folder):
    docs, labels = (spark.read.parquet(f"{small}/{name}.parquet").limit(0) for name in ("documents", "labels"))
    assert corpus_pipeline.run(spark, tables(docs, labels, folder)).collect() == []


def test_stages_on_hard_rows(spark, small, folder):
    """Nulls, empty and very long texts, repeated rows and ids, and columns with clashing or odd names."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = docs.filter("doc_id < 5").collect()
    long = " ".join(row.text or "" for row in docs.filter("doc_id < 40").collect()) * 3
    odd = [tuple(row) for row in first] + [(first[1].doc_id, "another text of the same id", "en", "s", 1)]
    odd += [(None, first[2].text, None, None, None), (None, None, None, None, None), (-1, None, "en", "s", None)]
    odd += [(-2, "", None, "s", 0), (-3, long, "en", "s", 1), (-4, long.upper(), "en", "s", 1), (-5, "\x00\x1c 42", "zz", "s", 1)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    names = ("a.b", "b`c", "gone", "best", "row", "k", "d", "n", "id", "digest", "label", "print", "score", "content")
    docs = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in names})
    docs = spark.read.parquet(f"{tables(docs, spark.read.parquet(f'{small}/labels.parquet'), folder)}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {tuple(row) for row in docs.collect()}
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert {tuple(row) for row in docs.collect()} <= before, name
        if name == "exact dedup":
            texts = [(row.text or "").encode().lower() for row in docs.collect()]
            assert len(texts) == len(set(texts))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    places = [(row.sequence_id, row.offset) for row in pieces]
    assert len(places) == len(set(places))
    assert {row.doc_id for row in pieces} == {row.doc_id for row in docs.collect()}
