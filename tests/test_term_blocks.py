import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricewright.operators import term_blocks as B
from pricewright.operators import text_features as TF
from pricewright.plans.text import document_ngrams
from pricewright.plans.views import Tables
from pricewright.session import CLEANUP_KEY, materialize


def _texts(n, seed=5):
    rng = random.Random(seed)
    words = [f"w{i:03d}" for i in range(150)] + ["é", "日本", "z" * 300, "z" * 300 + "q"]
    return [None, ""] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def _grams(text, low, high):
    tokens = re.findall(r"\w{2,}", (text or "").lower())
    return [" ".join(tokens[i : i + n]) for n in range(low, high + 1) for i in range(len(tokens) - n + 1)]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_") and f.endswith(".data")}


def test_blocks_return_their_terms():
    rng = random.Random(3)
    terms = sorted({x.encode() for t in _texts(300) for x in _grams(t, 1, 3)} | {b"\xff\xfe", b"a" * 700, b"a" * 700 + b"b"})
    bounds = sorted({t[:64] for t in rng.sample(terms, 9)} | {b"\x00", b"\xff\xff"})
    n, x = np.arange(len(terms)) - 5, np.linspace(-1, 1, len(terms))
    rows = B.blocks(pa.array(terms, pa.large_binary()), {"n": n, "x": x}, bounds).to_pylist()
    found = [B.block_terms(r).to_pylist() for r in rows]
    assert [t for f in found for t in f] == terms
    assert all(sum(b <= t for b in bounds) == r["bucket"] for r, f in zip(rows, found) for t in f)
    assert np.array_equal(np.concatenate([B.unpacked_numbers(r["n"], r["size"]) for r in rows]), n)
    assert np.array_equal(np.concatenate([B.unpacked_numbers(r["x"], r["size"], np.float64) for r in rows]), x)
    assert sum(len(r["shared"] + r["rest"] + r["text"]) for r in rows) < 0.4 * sum(map(len, terms))


def test_ngrams_are_shuffled_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_TERMS", 200)
    texts = [" ".join(re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], t).split()) if t else t for t in _texts(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = document_ngrams(Tables(spark, str(tmp_path)))
    plan = out._jdf.queryExecution().sparkPlan().toString().split("REPARTITION_BY_COL")
    assert len(plan) == 2 and "MapInArrow" in plan[1]
    got = {(r["ngram"], r["value"]): r["count"] for r in out.collect()}
    from pricewright.functions.text import clean_tokens

    expected = Counter()
    for (words,) in df.select(clean_tokens(F.col("text"), "alpha")).collect():
        expected.update((n, " ".join((words or [])[i : i + n])) for n in (1, 2, 3) for i in range(len(words or []) - n + 1))
    assert got == expected


@pytest.mark.parametrize("kind, width, min_df", [("count", (1, 3), 1), ("tfidf", (1, 2), 2), ("tfidf", (2, 3), 1), ("count", (1, 1), 1)])
def test_wide_vocabularies_by_ranges(spark, monkeypatch, kind, width, min_df):
    """Several chunks, buckets and blocks; other columns pass, vectors among them; copies and null texts too."""
    for name, value in (("HOT_TERMS", 10), ("CHUNK_BYTES", 900), ("CHUNK_ROWS", 7)):
        monkeypatch.setattr(TF, name, value)
    for name, value in (("BUCKET_BYTES", 2000), ("BUCKET_TERMS", 100), ("BLOCK_TERMS", 300)):
        monkeypatch.setattr(B, name, value)
    texts = _texts(150) * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    df = TF.BagOfWords("count", max_features=3).fit(df, "text").transform(df, "few").withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    assert spark.conf.get(CLEANUP_KEY, None) != "true"
    model = TF.BagOfWords(kind, width, min_df).fit(df, "text")
    dfs = Counter(g for t in texts for g in set(_grams(t, *width)))
    terms = sorted((g for g, n in dfs.items() if n >= min_df), key=str.encode)
    assert [tuple(r) for r in model.terms.orderBy("index").select("term", "index", "df").collect()] == [(g, i, dfs[g]) for i, g in enumerate(terms)]
    out = model.transform(df, "v")
    assert out.columns == [*df.columns, "v"] and out.schema["few"].dataType == df.schema["few"].dataType
    before = {r["id"]: r for r in df.collect()}
    place = {g: i for i, g in enumerate(terms)}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        old = before[r["id"]]
        assert (r["text"], r["few"], r["at"]) == (old["text"], old["few"], old["at"])
        tf = Counter(g for g in _grams(r["text"], *width) if g in place)
        cells = {place[g]: n * (1 if kind == "count" else np.log((1 + len(texts)) / (1 + dfs[g])) + 1) for g, n in tf.items()}
        norm = 1 if kind == "count" else np.sqrt(sum(x * x for x in cells.values()))
        assert r["v"].size == len(terms) and list(r["v"].indices) == sorted(cells)
        assert list(r["v"].values) == pytest.approx([cells[i] / norm for i in sorted(cells)])


def test_written_tables_leave_no_shuffle(spark):
    before = _shuffle_files(spark)
    stored = materialize(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "counted", compact=True)
    assert not _shuffle_files(spark) - before
    assert stored.agg(F.sum("count")).first()[0] == 10_000
