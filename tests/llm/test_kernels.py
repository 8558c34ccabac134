"""Array kernels against plain Python."""

import random

import numpy as np
import pytest

from pricewright.llm import token_output
from pricewright.llm.html_text import visible_text
from pricewright.llm.packing import best_boundaries
from pricewright.llm.range_coder import decode_blocks, encode_blocks
from pricewright.llm.token_counts import Counter
from pricewright.llm.token_output import Encoder, crc_before
from pricewright.llm.toxicity import maximal_segments

PIECES = ["'s", "'ll", "'t", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "'", "　", "<|endoftext|>", "zz", "aaaaaaa", "日本", "😀", "\r\n", "_"]


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_counts_and_ids_are_the_librarys():
    path = tokenizer_path()
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randint(0, 14))) for _ in range(2000)]
    ids = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert Counter(path).counts(texts).tolist() == [len(i) for i in ids]
    flat, counts = Encoder(path).encode(texts)
    assert counts.tolist() == [len(i) for i in ids]
    assert flat.tolist() == [x for i in ids for x in i]


def test_blocks_round_trip_and_damage_shows():
    g = np.random.default_rng(1)
    blocks = [g.integers(0, 50257, n) for n in (0, 1, 5, 3000)] + [np.full(3000, 7), np.array([1, 2, 3] * 500), g.zipf(1.3, 3000) % 50257]
    coded = encode_blocks(blocks, 16)
    assert all(a.tolist() == b.tolist() for a, b in zip(blocks, decode_blocks(coded)))
    assert len(coded[4]) < 200  # repeats cost next to nothing
    broken = bytearray(coded[3])
    broken[40] ^= 1
    with pytest.raises(ValueError):
        decode_blocks([bytes(broken)])


def test_crc_shares():
    import zlib

    a, b, c = b"abcd" * 7, b"xy" * 10, b"0123"
    assert crc_before(zlib.crc32(a), len(b) + len(c)) ^ crc_before(zlib.crc32(b), len(c)) ^ zlib.crc32(c) == zlib.crc32(a + b + c)


def test_segments_are_all_maximal_ones():
    def plain(s):  # the greatest segment, then the same on either side of it
        best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = best[2:]
        return plain(s[:i]) + [(i, j, best[0])] + [(a + j, b + j, v) for a, b, v in plain(s[j:])]

    rnd = random.Random(3)
    for _ in range(200):
        s = [rnd.choice([-7, -5, -3, -2, 1, 2, 4, 8]) + rnd.random() / 8 for _ in range(rnd.randint(0, 14))]
        found = maximal_segments(np.array(s))
        # recursion on the greatest segment gives the same maximal segments (no ties here)
        assert [(a, b, round(v, 6)) for a, b, v in found] == [(a, b, round(v, 6)) for a, b, v in plain(s)]


def test_boundaries_have_least_padding():
    from itertools import combinations

    rnd = random.Random(2)
    for _ in range(30):
        lengths = sorted(rnd.sample(range(1, 40), 7))
        counts = [rnd.randint(1, 9) for _ in lengths]

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))

        best = min(padding([*c, lengths[-1]]) for c in combinations(lengths[:-1], 2))
        found = best_boundaries(np.array(lengths), np.array(counts), 3)
        assert padding(found) == best and len(found) == 3
    assert best_boundaries(np.array([]), np.array([]), 3) == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>one<p>two <b>bold</b>  word", "one\n\ntwo bold word"),
        ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c"),
        ("<table><tr><th>n<th>long name<tr><td>10<td>x</table>", "n   long name\n10  x"),
        ("<div>a<div style='display:none'>no</div><span hidden>no</span>b</div>", "ab"),
        ("<script>var a='<p>';</script>caf&eacute; &#8217;s<!-- c --><br>x", "café ’s\nx"),
        ("<pre>a  b\n c</pre>", "a  b\n c"),
        ("a < b <unclosed", "a < b"),
        ("", ""),
        (None, ""),
    ],
)
def test_rendering(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<html><head><title>T</title><h1>A</h1><p>B", "A\n\nB"),
        ("<head><meta name=a><link rel=b> <style>c</style>\nword<title>T</title> more", "word more"),
        ("<head><noscript><p>no</p></noscript><template><b>no</b></template><script>no</script><div>a</div>", "a"),
        ("<head></br>a", "a"),
    ],
)
def test_head_without_end_tag(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p class=don't>Hello", "Hello"),
        ('<img alt="5" screen">Hello', "Hello"),
        ('<a href=/search?q="x>Hello</a> "you"', 'Hello "you"'),
        ("<p 'a' b\">Hello <i title = 'a > b'>you</i>", "Hello you"),
        ('<p a="1"b=\'>\'c="x>y">Hello', "Hello"),
        ("<p class=don't hidden>no<p =\">yes", "yes"),
        ("<p title=>Hello<p title= >you", "Hello\n\nyou"),
    ],
)
def test_quotes_in_tags(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><form><td>a</td></form><td>b</td></tr></table>", "a  b"),
        ("<table><tr><a><td>a</td></a><td>b</td></table>", "a  b"),
        ("<table><tr>note<td>x<tr><td>y</table>", "note\nx\ny"),
        ("<table><tbody><tr><td>a</td><p>p</p><i>i</i><tr><td>b</table>c", "p\n\ni\na\nb\n\nc"),
        ("<table><tr><form><input></form>only</table>", "only"),
        ("<table><tr><noscript><td>no</td></noscript><td>b</table>", "b"),
        ("<table><tr><td><table><tr><b><td>in</td></b></table><td>b</table>", "in  b"),
        ("<tr><td>a<td>b</tr>", "a  b"),
    ],
)
def test_rows_keep_everything(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>if <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> then", "if x= 1 2 then"),
        ("<math><semantics><mi>y</mi><annotation>no</annotation></semantics></math>z", "yz"),
        ("<svg><title>no</title>no<g><text>A<tspan>b</tspan></text><text>C</text></g><defs><text>no</text></defs></svg> d", "Ab C d"),
        ("<svg><foreignObject><p>a</p></foreignObject><style>no</style><path d='M'/></svg>b", "a\n\nb"),
        ("a<svg width=5 /> b <math/>c<div>d</div>", "a b c\nd"),
        ("<svg><title/><circle/><text><![CDATA[a > b]]></text></svg> c", "a > b c"),
        ("<svg><path d=''><p>a", "a"),
        ("<svg width=5/><text>a</text></svg>b", "ab"),
        ("<span aria-hidden=true>a</span>b", "ab"),
        ("size <select><option>S<option selected>M<option>L</select> left", "size M left"),
        ("<select><option disabled>no<option>S<option>M</select>", "S"),
        ("<select><option selected disabled hidden>Choose<option>S</select>", "Choose"),
        ("<select multiple><optgroup label=g><option>S<optgroup label=h><option label=Mm>M</select>", "g S h Mm"),
        ("<select><option>S<input>a<select hidden><option>no</select>b", "S ab"),
        ("<table><tr><td><select><option>S<td>b</table>", "S  b"),
        ("<select></select>a", "a"),
        ("<tr>a<math><tr>b</tr></math>", "ab"),
        ("<table><tr>a<u><caption>b<tr><td>c</table>", "a\nb\nc"),
    ],
)
def test_visibility(page, text):
    assert visible_text(page) == text


def test_an_encoder_short_of_memory_keeps_what_it_uses(monkeypatch):
    path = tokenizer_path()
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_output, "REMEMBERED", 40)
    encoder, learned = Encoder(path), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.extend(new), learn(new)))
    library = Tokenizer.from_file(path)
    for k in range(30):
        texts = [f"always the same words é {k * 7919 + i * 104729:x}" for i in range(9)]
        ids, counts = encoder.encode(texts)
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [x for e in expected for x in e]
    assert learned.count(b" words") == 1
    assert len(encoder.book) < 200


def test_blocks_side_by_side_leave_no_small_rest():
    few = token_output.LANES + 100
    assert token_output.side_by_side(few) == [(0, few)]
    for n in (0, 1, few, 3 * few, 100 * few + 1):
        runs = token_output.side_by_side(n)
        assert [x for a, b in runs for x in range(a, b)] == list(range(n))
        assert all(b - a <= 1.5 * token_output.LANES for a, b in runs)


def test_an_id_takes_a_word_at_most_and_carries_go_back():
    g = np.random.default_rng(2)
    blocks = [g.integers(0, 1 << 16, 4096) for _ in range(40)] + [np.repeat(g.integers(0, 1 << 16, 64), 64) for _ in range(40)]
    blocks += [np.where(g.random(n) < 0.02, g.integers(0, 1 << 16, n), np.arange(n) % 3) for n in range(3000, 3040)]
    coded = encode_blocks(blocks, 16)
    assert all(a.tolist() == b.tolist() for a, b in zip(blocks, decode_blocks(coded)))
    # words of 32 bits; 16 bits of a random id, as good as no loss
    assert all(len(c) % 4 == 0 for c in coded) and max(map(len, coded[:40])) < 4096 * 2.4
    for bits in (9, 19):
        some = [g.integers(0, 1 << bits, 500), np.array([(1 << bits) - 1, 0] * 300)]
        assert all(a.tolist() == b.tolist() for a, b in zip(some, decode_blocks(encode_blocks(some, bits))))
