"""Alignment, sharding and ranked search against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricewright.llm import lexical_search, sharding
from pricewright.llm.alignment import align_tokenizers, common_ends, pair_encoder
from pricewright.llm.jaccard import keep_one_per_group, near_duplicates
from pricewright.llm.lexical_search import rank_documents
from pricewright.llm.sharding import differenced, shard_by_bytes
from pricewright.llm.token_counts import Counter as TokenCounter, byte_symbols
from pricewright.llm.token_output import Encoder

SCHEMA = "doc_id bigint, text string, size int, shard string, slot int, block int, pair int, term string, `row.key` string"


def corpus():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choices("abcdeéfgh中", k=rnd.randint(1, 8))) for _ in range(300)]
    rows = []
    for i in range(150):
        text = rnd.choice(" \n").join(rnd.choices(vocabulary, k=rnd.randint(0, 90))).capitalize()
        if i % 7 == 3:
            text = (rows[rnd.randrange(len(rows))][1] or "").upper()
        if i % 11 == 5:
            text += rnd.choice([" <|endoftext|> x", "  two  blanks ", "\n\n  lines \t", " it's they'll", " <s> <0x41> <unk>", " 12345 ___ $$"])
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " "), (203, "!!! ..."), (204, "a" * 4000), (205, " ".join(vocabulary) * 30), (206, "has ▁ sign"), (207, "\x00\x1c　 x")]
    rows += [(None, "no id"), (None, None), (5, rows[5][1]), (5, rows[5][1])] + [(300 + k, "hot text of many rows") for k in range(60)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "s", 2, 3, 4, "t", "r") for i, t in corpus()], SCHEMA).repartition(4).persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


@pytest.fixture(scope="module")
def paths():
    found = pytest.importorskip("public_tokenizers")
    return found.path("byte_bpe_50k.json"), found.path("piece_bpe_32k.model")


def test_common_ends():
    rnd = random.Random(1)
    for _ in range(400):
        a = set(rnd.sample(range(1, 300), rnd.randint(1, 200)))
        b = set(rnd.sample(range(1, 300), rnd.randint(1, 200))) if rnd.random() < 0.5 else {x for x in a if rnd.random() < 0.98} | {rnd.randrange(1, 300)}
        a, b = (np.array(sorted({*x, 300}), np.int64) for x in (a, b))
        at_a, at_b = common_ends(a, b)
        both = np.intersect1d(a, b)
        assert a[at_a].tolist() == both.tolist() == b[at_b].tolist()
    long = np.arange(1, 100_001)
    assert common_ends(long, long)[1].tolist() == list(range(100_000))


def by_hand(rows, paths):
    """The contract's columns, by plain loops over the libraries' whole-text ids."""
    pair = pair_encoder(*paths)
    value = {c: b for b, c in enumerate(byte_symbols())}
    linked = []
    for doc, text in rows:
        ids_a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = pair.b.encode(text) if text else []
        bytes_a = [bytes(value[c] for c in pair.a.id_to_token(i)) for i in ids_a]
        pieces = [pair.b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            linked.append((doc, [], [], 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links, shown, group_a, group_b, at = [], [], [], [], 0
        for k, x in enumerate(ends_a):
            group_a.append(str(ids_a[k]))
            start = ends_a[k - 1] if k else 0
            for m, y in enumerate(ends_b):
                if min(x, y) > max(start, ends_b[m - 1] if m else 0):
                    links.append((ids_a[k], ids_b[m]))
            if x in ends_b:
                while at < len(ends_b) and ends_b[at] <= x:
                    group_b.append(str(ids_b[at]))
                    at += 1
                shown.append(",".join(group_a) + "|" + ",".join(group_b))
                group_a, group_b = [], []
        linked.append((doc, ids_a, ids_b, len(shown), links, hashlib.sha256(";".join(shown).encode()).hexdigest()))
    count = Counter(p for *_, links, _ in linked for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return sorted(
        [(d, len(a), len(b), g, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha) for d, a, b, g, links, sha in linked], key=repr
    )


def test_alignment(docs, empty, paths):
    found = align_tokenizers(docs, *paths)
    assert [f.simpleString() for f in found.schema.fields[:2]] == ["doc_id:bigint", "n_a:bigint"]
    rows = [(i, t if t is None or len(t) < 2000 else t[:2000]) for i, t in corpus()]
    short = docs.selectExpr("doc_id", "substring(text, 1, 2000) AS text", "size", "block", "pair")
    assert sorted(map(tuple, align_tokenizers(short, *paths).collect()), key=repr) == by_hand(rows, paths)
    totals = {r.doc_id: r for r in found.where("doc_id in (204, 205, 206)").collect()}
    assert totals[204].n_a and totals[205].n_links == totals[205].n_a + totals[205].n_b - totals[205].n_groups and totals[206].n_links == 0
    assert align_tokenizers(empty, *paths).count() == 0


def test_alignment_layout(docs, paths):
    one = sorted(map(tuple, align_tokenizers(docs.coalesce(1), *paths).collect()), key=repr)
    assert one == sorted(map(tuple, align_tokenizers(docs.orderBy("text"), *paths).collect()), key=repr)


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("letters", ["ab", "th", "qz", "ez"])
def test_ids_of_colliding_texts(paths, letters):
    library = pair_encoder(*paths).a
    encoder, counter = Encoder(paths[0]), TokenCounter(paths[0])
    for n in (512, 1024, 2048, 4096, 8192):
        for a, b in (letters, letters[::-1]):
            texts = [thue_morse(n, a, b), thue_morse(n, b, a)]
            wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
            ids, counts = encoder.encode(texts)
            assert ids.tolist() == sum(wanted, []) and counts.tolist() == counter.counts(texts).tolist() == [len(w) for w in wanted]


def test_long_pretoken(paths):
    import time

    rnd = random.Random(2)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "a"):
        text = "".join(rnd.choices(letters, k=160_000))
        counter, start = TokenCounter(paths[0]), time.thread_time()
        assert counter.counts([text])[0] == len(pair_encoder(*paths).a.encode(text, add_special_tokens=False).ids)
        assert time.thread_time() - start < 4


def spread(sizes, shard_of, shards):
    loads = [0] * shards
    for size, shard in zip(sizes, shard_of):
        loads[shard] += size
    return max(loads) - min(loads)


def test_differencing():
    assert differenced([], 3) == [] and differenced([5], 1) == [0]
    # the textbook case: 8, 7, 6, 5, 4 differ by 2 after differencing
    assert spread([8, 7, 6, 5, 4], differenced([8, 7, 6, 5, 4], 2), 2) == 2
    rnd = random.Random(3)
    for shards in (2, 5, 24):
        sizes = sorted((rnd.randint(1, 100_000) for _ in range(4000)), reverse=True)
        largest_first = [0] * shards
        for s in sizes:
            largest_first[largest_first.index(min(largest_first))] += s
        assert spread(sizes, differenced(sizes, shards), shards) <= max(largest_first) - min(largest_first)
    rows = [10**6] + [7] * 900  # one group of nearly everything
    loads = Counter()
    for s, k in zip(rows, differenced(rows, 4)):
        loads[k] += s
    assert sorted(loads.values())[:3] == [2100, 2100, 2100]


def shards_by_hand(rows, found, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert len(found) == len(rows) and {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    slots, home = defaultdict(list), defaultdict(set)
    for r in found:
        assert 0 <= r.shard < shards
        slots[r.shard].append((r.slot, r.doc_id))
        home[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in home.values())
    for listed in slots.values():
        listed.sort()
        assert [s for s, _ in listed] == list(range(len(listed)))
        ids = [-1 if d is None else d for _, d in listed]
        assert ids == sorted(ids)


def test_shards(docs, empty, monkeypatch):
    rows = corpus()
    found = shard_by_bytes(docs, 6).collect()
    shards_by_hand(rows, found, 6)
    sums = Counter()
    for r in found:
        sums[r.shard] += r.size
    largest = max(Counter({t: (len((t or "").encode()) + 8) * n for t, n in Counter(t or "" for _, t in rows).items()}).values())
    assert max(sums.values()) <= max(largest, sum(sums.values()) / 6 * 1.02)
    # few bins: most groups are light; another layout gives the same shards
    a = shard_by_bytes(docs, 6, items=40)
    b = shard_by_bytes(docs.coalesce(1).orderBy("text"), 6, items=40)
    assert sorted(map(tuple, a.select("doc_id", "shard", "size", "slot").collect()), key=repr) == sorted(map(tuple, b.select("doc_id", "shard", "size", "slot").collect()), key=repr)
    shards_by_hand(rows, a.collect(), 6)
    assert shard_by_bytes(empty, 6).count() == 0 and sharding.ITEMS > 1000


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ranked_by_hand(rows, items, k):
    documents = [(i, Counter(TERM.findall(lowered(t)))) for i, t in rows]
    documents = [(i, c) for i, c in documents if c]
    n_docs, n_terms = len(documents), sum(c.total() for _, c in documents)
    holders = Counter(t for _, c in documents for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c in documents:
            m, score = 100 - 25 + 25 * c.total() * n_docs // n_terms, 0
            for t in TERM.findall(lowered(text)):
                if t in c:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, depth, queries", [(1 << 22, 64, 1 << 22), (500, 2, 300)])
def test_search(spark, docs, empty, monkeypatch, block, depth, queries):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical_search, "FIRST_DEPTH", depth)
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", queries)
    rows = corpus()
    items = [(k, " ".join((rows[k][1] or "").split()[:25])) for k in range(12)]
    items += [(50, "hot text of many rows"), (51, None), (52, ""), (53, "nothing matches 0000"), (None, rows[8][1]), (54, "Hot HOT hot " + (rows[9][1] or "")), (50, "hot text of many rows"), (50, "rows rows")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, doc_id string, score int")
    found = rank_documents(docs, table, 20)
    assert sorted(map(tuple, found.collect()), key=repr) == ranked_by_hand(rows, [i for i in items if i[1] is not None], 20)
    assert rank_documents(empty, table).count() == 0 and rank_documents(docs, table.where("1 = 0")).count() == 0


def test_near_duplicates_of_any_layout(spark):
    rnd = random.Random(21)
    words = ["w%d" % k for k in range(200)]
    rows = []
    for i in range(60):
        body = rnd.choices(words, k=60)
        for copy in range(rnd.randint(1, 5)):
            changed = list(body)
            if copy:
                changed[rnd.randrange(60)] = "zz%d" % copy
            rows.append((None if rnd.random() < 0.05 else rnd.randrange(500), " ".join(changed) + rnd.choice(["", ".", " !"])))
    rows += rows[:10] + [(None, None), (7, ""), (8, "..")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    answers, kept = [], []
    for layout in (table.coalesce(1), table.orderBy("text"), table.orderBy(table.doc_id.desc()).repartitionByRange(7, "doc_id")):
        answers.append(Counter(tuple(r) for r in near_duplicates(layout).collect()))
        kept.append(Counter(tuple(r) for r in keep_one_per_group(layout).collect()))
    assert answers[0] == answers[1] == answers[2] and kept[0] == kept[1] == kept[2]
    assert len(set(kept[0])) == sum(kept[0].values()) < len(set(rows))
    # of each group the row of the least id, by its digest among equal ids
    sets = {r: frozenset(zip(*[re.findall("[a-z0-9]+", r[1] or "")[k:] for k in range(5)])) or frozenset([r[1] or ""]) for r in set(rows)}
    group = {r: r for r in sets}
    for a in sets:
        for b in sets:
            if group[a] != group[b] and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9 and all(isinstance(x, tuple) for x in sets[a] | sets[b])):
                group = {r: group[a] if g == group[b] else g for r, g in group.items()}
    least = {}
    for r, g in group.items():
        order = (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest())
        least[g] = min(least.get(g, (order, r)), (order, r), key=lambda x: x[0])
    assert {(i, t or "") for i, t in kept[0]} == {(r[0], r[1] or "") for _, r in least.values()}
