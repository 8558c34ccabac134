"""Operators against brute force on small tables with nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricewright.llm import jaccard
from pricewright.llm.decontaminate import contamination, without_contaminated
from pricewright.llm.exact_dedup import exact_duplicates, keep_one_per_text
from pricewright.llm.html_text import page_text
from pricewright.llm.packing import pack
from pricewright.llm.secrets import KINDS, scan_secrets
from pricewright.llm.suffix_dedup import repeated_substrings
from pricewright.llm.token_counts import count_tokens
from pricewright.llm.token_output import read_token_ids, token_digests, write_token_ids
from pricewright.llm.toxicity import toxicity, without_toxic
from pricewright.session import fresh_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, pair int, key string, `row.key` string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus():
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choices("abcdeéfgh", k=rnd.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rnd.choices(vocabulary, k=90))
    rows = []
    for i in range(160):
        body = rnd.choices(vocabulary, k=rnd.randint(0, 120))
        kind = i % 8
        if kind == 1:
            body = passage.split()[: rnd.randint(20, 90)] + body
        text = " ".join(body).capitalize()
        if kind == 2 and rows:
            text = (rows[rnd.randrange(len(rows))][1] or "").upper()
        if kind == 3 and rows:
            base = (rows[rnd.randrange(len(rows))][1] or "x").split(" ")
            base[rnd.randrange(len(base))] = "zzz"
            text = " ".join(base)
        if kind == 4:
            text += rnd.choice([' password = "hunter22" ', " AKIA" + "Q1" * 9, " deadbeef" * 1 + "0" * 20, " secret=token :abcdefgh", " tOkEn: abc", " Zx9+Qk2LmV7tR4yWb8Nc1 "])
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, "!!! ..."), (203, "a" * 3000), (204, passage * 40), (None, "no id"), (None, None), (5, rows[5][1]), (5, rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "d", 2, "k", "r") for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


@pytest.fixture(scope="module")
def benchmark(spark):
    texts = [t for _, t in corpus()]
    items = [(1, " ".join((texts[1] or "").split()[:30])), (2, "a short item"), (3, None), (None, (texts[9] or "")[:150]), (2, "a short item")]
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_exact(docs, empty):
    rows = [r.asDict() for r in exact_duplicates(docs, keep="largest").collect()]
    groups = defaultdict(list)
    for i, t in corpus():
        groups[lowered(t)].append(i)
    expected = Counter()
    for body, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[(i, best, len(ids), hashlib.sha256(body.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    assert sum(r["kept"] for r in rows) == len(groups)
    kept = keep_one_per_text(docs)
    assert kept.columns == docs.columns and sorted(lowered(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_duplicates(empty).count() == 0 == keep_one_per_text(empty).count()


def test_repeated_substrings(docs, empty):
    length = 400
    rows = corpus()
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    expected = Counter()
    for i, t in rows:
        b = (t or "").encode()
        change = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                change[k] += 1
                change[k + length] -= 1
        gone = np.cumsum(change)[:-1] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        expected[(i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())] += 1
    found = repeated_substrings(docs).drop("spans").collect()
    assert Counter(map(tuple, found)) == expected
    assert repeated_substrings(empty).count() == 0


def test_repeated_substrings_when_common_parts_share_a_hash(spark, monkeypatch):
    from pricewright.llm import suffix_dedup

    rnd = random.Random(5)
    line = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    shared, close = line(900), line(399)
    texts = [line(300) + shared + line(200), line(150) + "A" + shared[100:800] + "B", line(500) + "C" + close + "D" + line(90), close + "E" + line(400), line(700)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = sorted(map(tuple, repeated_substrings(rows).drop("spans").collect()))
    assert [r[2] for r in expected] == [700, 700, 0, 0, 0]
    columns, cells, store = {}, suffix_dedup.cell_rows, suffix_dedup.materialize

    def collide(texts, jobs, length, width):
        found = cells(texts, jobs, length, width)
        return found.withColumn("i1", F.lit(7).cast("bigint")) if width > 1 else found

    def recorded(df, label):
        columns[label] = df.columns
        return store(df, label)

    monkeypatch.setattr(suffix_dedup, "cell_rows", collide)
    monkeypatch.setattr(suffix_dedup, "materialize", recorded)
    assert sorted(map(tuple, repeated_substrings(rows).drop("spans").collect())) == expected
    # wide cells store one hash of their common part, single starts both
    assert "i2" not in columns["cells-128"] + columns["cells-8"] and "i2" in columns["starts"]


def test_near_duplicates(docs, empty, monkeypatch):
    sets, members = {}, defaultdict(list)
    for i, t in corpus():
        w = WORD.findall(lowered(t))
        s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset([("none", t or "")])
        sets[s] = not w
        members[s].append(i)
    links = Counter()
    for a in sets:
        for b in sets:
            if a is not b and not sets[a] and not sets[b] and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[a] += 1
    expected = Counter()
    for s, ids in members.items():
        lead = min((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[(i, lead, len(ids), links[s])] += 1
    for block in (jaccard.BLOCK, 3):  # also with buckets of several blocks
        monkeypatch.setattr(jaccard, "BLOCK", block)
        found = jaccard.near_duplicates(docs).collect()
        assert Counter((r.doc_id, r.class_id, r.copies, r.n_links) for r in found) == expected
    kept = jaccard.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    groups = {(r.group_id, r.class_id if r.group_id is None else 0) for r in found}
    assert abs(kept.count() - len(groups)) <= 1  # texts with null ids alone share the null group name
    assert jaccard.near_duplicates(empty).count() == 0


def test_token_counts_and_output(spark, docs, empty, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in corpus()]
    found = Counter((r.doc_id, r.n_tokens, r.over_limit) for r in count_tokens(docs, path).collect())
    assert found == Counter((i, len(x), len(x) > 1024) for i, x in ids)
    assert count_tokens(empty, path).count() == 0
    folder = fresh_path(spark, "ids")
    write_token_ids(docs, folder, path)
    rows = token_digests(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for i, x in ids)
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert Counter((r.doc_id, tuple(r.ids)) for r in read_token_ids(spark, folder).collect()) == Counter((i, (*x, 0)) for i, x in ids)
    nothing = fresh_path(spark, "ids")
    write_token_ids(empty, nothing, path)
    assert token_digests(spark, nothing).count() == 0


def test_secrets(docs, empty):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

    def base(t):
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return sorted(found)

    expected = Counter()
    for i, t in corpus():
        spans = base(t or "")
        listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        expected[(i, *[sum(k == n for _, k, _ in spans) for n in range(3)], hashlib.sha256(listed.encode()).hexdigest())] += 1
    rows = scan_secrets(docs).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == expected
    assert any("entropy:" in r.spans for r in rows)
    assert scan_secrets(empty).count() == 0


def test_secret_classes(spark):
    hexes, mixed, letters = "9F86D081884C7D659A2FEAA0C55AD015", "Zx9+Qk2LmV7tR4yWb8Nc1Hd5", "QwErTyUiOpAsDfGhJkLzXcVbNmQw"
    texts = {
        1: f"session_id={hexes} end",
        2: f"path/{hexes[:22].lower()} end",
        3: f"name={letters} end",
        4: f"example={mixed} end",
        5: "docs/example/some/path/with-long_names/and-more/words and donaudampfschifffahrtsgesellschaft",
        6: "550e8400-e29b-41d4-a716-446655440000 2024-01-01-2024-01-01-2024 12345678901234567890123456",
        7: "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        8: f"{mixed} {mixed}",
        9: "=" * 500,
    }
    rows = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}

    def entropy(i):
        return [texts[i][int(s) : int(e)] for k, s, e in (x.split(":") for x in rows[i].spans.split(",") if x) if k == "entropy"]

    for i, secret in ((1, hexes), (2, hexes[:22].lower()), (3, letters), (4, mixed)):
        assert any(secret in found for found in entropy(i)), i
    assert entropy(8) == [mixed, mixed] and rows[8].n_entropy == 2
    assert not any(rows[i].n_entropy for i in (5, 6, 7, 9))


def test_contamination(docs, empty, benchmark):
    windows = defaultdict(set)
    for r in benchmark.collect():
        w = WORD.findall(lowered(r.text))
        for k in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + min(13, len(w))])].add("" if r.item_id is None else str(r.item_id))
    expected, bad = Counter(), Counter()
    for i, t in corpus():
        w, hit, items = WORD.findall(lowered(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    items |= windows[tuple(w[k : k + n])]
        flag = bool(hit) and 20 * len(hit) >= len(w)
        expected[(i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), flag)] += 1
        bad[(i, t)] += not flag
    found = contamination(docs, benchmark)
    assert Counter(map(tuple, found.collect())) == expected and sum(k[-1] for k in expected)
    kept = without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == +bad
    assert contamination(empty, benchmark).count() == 0
    assert {r.n_hit for r in contamination(docs, benchmark.where("1 = 0")).collect()} == {0}


def test_toxicity(spark, docs, empty):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=60) + ["zqfoul"] * (i % 4 == 0) + rnd.choices(vocabulary, k=9))) for i in range(600)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(500)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    found = toxicity(texts, labels).collect()
    held = [r for r in found if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert {r.doc_id % 4 for r in without_toxic(texts, labels).collect()} >= {1, 2, 3}
    assert toxicity(docs, labels).count() == docs.count()
    assert without_toxic(docs, labels.where("toxic = 0")).columns == docs.columns
    assert toxicity(empty, labels).count() == 0
    assert {r.predicted for r in toxicity(texts, labels.where("1 = 0")).collect()} <= {0, 1}


def test_packing(docs, empty, path):
    rows = pack(docs, path, longest=64, buckets=4, budget=256).collect()
    tokens = Counter((r.doc_id, r.n_tokens) for r in count_tokens(docs, path).collect())
    total = Counter()
    for (i, n), k in tokens.items():
        total[i] += n * k
    assert {i: sum(r.length for r in rows if r.doc_id == i) for i in total} == dict(total)
    slots = Counter((r.bucket, r.batch, r.slot) for r in rows if r.bucket is not None)
    assert max(slots.values()) == 1
    for r in rows:
        assert (r.bucket is None) == (r.length == 0)
        assert r.bucket is None or r.length <= r.bucket and r.slot < max(1, 256 // r.bucket)
    full = Counter((r.bucket, r.batch) for r in rows if r.bucket is not None)
    assert all(n == 256 // b for (b, k), n in full.items() if (b, k + 1) in full)
    assert pack(empty, path).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([(1, "<p>a<p>b", 1), (None, None, 2), (3, "", 3), (3, "<b>x", 3)], "page_id bigint, html string, text int")
    found = sorted((r.page_id or 0, r.text, r.n_chars, r.n_lines) for r in page_text(pages).collect())
    assert found == [(0, "", 0, 0), (1, "a\n\nb", 4, 3), (3, "", 0, 0), (3, "x", 1, 1)]


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert kept.exceptAll(docs).isEmpty(), name
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()} and rows


def test_pipeline_decisions(spark, tmp_path):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(3, 7))) for _ in range(300)]
    rows, toxic = [], set()
    for i in range(300):
        body = rnd.choices(words, k=rnd.randint(30, 60))
        if i % 5 == 0:
            body[5:5] = ["vile", "scum", "idiots"] * 3
            toxic.add(i)
        if i % 5 == 1 and i > 5:  # exact copy, but for letter case
            body = rows[i - 4][1].upper().split()
        if i % 5 == 2 and i > 5:  # near copy, in chains
            body = rows[i - 5][1].split()
            body[-1] = rnd.choice(words)
        rows.append((i, " ".join(body)))
    rows += [(300, ""), (301, ""), (302, "!!!"), (303, "one two"), (304, "One Two")]
    item = " ".join(rows[8][1].split()[:20])
    rows += [(305, rows[3][1] + " " + item), (306, rows[4][1])]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = dict(rows)

    def after(name, ids):
        given = docs.where(docs.doc_id.isin(sorted(ids)))
        kept = [r.doc_id for r in stages[name](spark, given, folder).collect()]
        assert len(kept) == len(set(kept)) and set(kept) < ids, name
        return set(kept)

    clean = after("toxicity", set(texts))
    assert clean == {r.doc_id for r in toxicity(docs, labels).collect() if not r.predicted}
    assert len(clean ^ (set(texts) - toxic)) <= 0.03 * len(texts)

    single = after("exact_dedup", clean)
    assert single == set({lowered(texts[i]): i for i in sorted(clean)}.values())

    shingles = {}
    for i in single:
        w = WORD.findall(lowered(texts[i]))
        shingles[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset([("none", texts[i])])
    group = {i: i for i in single}
    for a in sorted(single):
        for b in sorted(single):
            if a < b and group[a] != group[b] and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]) - 1e-9:
                group = {i: group[a] if g == group[b] else g for i, g in group.items()}
    apart = after("ngram_jaccard", single)
    assert sorted(group[i] for i in apart) == sorted(set(group.values()))

    window = WORD.findall(lowered(item))
    windows = {tuple(window[k : k + 13]) for k in range(len(window) - 12)}
    expected = set()
    for i in apart:
        w, hit = WORD.findall(lowered(texts[i])), set()
        for k in range(len(w) - 12):
            if tuple(w[k : k + 13]) in windows:
                hit.update(range(k, k + 13))
        if not hit or 20 * len(hit) < len(w):
            expected.add(i)
    final = after("decontaminate", apart)
    assert final == expected

    pieces = stages["packing"](spark, docs.where(docs.doc_id.isin(sorted(final))), folder).collect()
    # places in a batch follow the order of rows, which may differ between runs
    whole = Counter((r.doc_id, r.length, r.bucket) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == Counter((r.doc_id, r.length, r.bucket) for r in pieces) and {r.doc_id for r in pieces} == final
