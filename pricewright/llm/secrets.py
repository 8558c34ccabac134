"""Secret scan in DataFrame operations only: known forms, and entropy over sliding windows.

Spans are (kind, start, end) in code points, end exclusive.

* ``assign``, ``access``, ``hex``: leftmost non-overlapping matches of fixed forms.
* ``entropy``: in candidate strings (runs of ``[A-Za-z0-9+/_=-]`` of ``WINDOW`` or
  more characters) the longest runs of each character class are scanned by a window
  of ``WINDOW`` characters. Its Shannon entropy follows from per-character counts
  that each step changes by one in and one out. The threshold is that of the class.
  Windows above it are merged into spans, and spans that match an allow-list
  pattern are suppressed. Spans of several classes that overlap are merged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.let import let
from pricewright.llm.tables import column, text_or_empty

KINDS = ("assign", "access", "hex", "entropy")

# The forms that count as secrets.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

WINDOW = 20
#: Runs of each character class and the bits per character above which a window counts. In the last two classes,
#: whose alphabet joins words, a run that is an allowed string as a whole is not scanned.
CLASSES = (
    (r"[0-9a-fA-F]{20,}", 3.2, False),
    (r"(?<![0-9a-z])(?=[a-z]*[0-9])[0-9a-z]{20,}", 3.7, False),
    (r"[A-Za-z0-9]{20,}", 3.9, False),
    (r"[A-Za-z0-9+/_-]{20,}={0,2}", 3.9, True),
    (r"[A-Za-z0-9+/_=-]{20,}", 3.9, True),
)
#: Spans that are no secrets: numbers and dates, UUIDs, words joined by signs, placeholders.
ALLOWED = (
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]*([+/_=-]+([A-Za-z]+|[0-9]+))+[+/_=-]*$",
    r"(?i)example|placeholder|xxxx|0123456789|abcdefgh",
)
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"


def _located(text: Column, pattern: str, kind: str, likely: Column, value_group: int | None = None) -> Column:
    """Matches as array<struct<start, end, kind, found, value>>.

    Each match of the wider pattern is the gap before a match and the match, or
    the gap before the end of the text, so lengths add up to positions.
    """
    wide = r"(?s)(.*?)(?:(" + pattern + r")|\z)"
    gaps, found = (F.regexp_extract_all(text, F.lit(wide), F.lit(g)) for g in (1, 2))
    value = F.regexp_extract_all(text, F.lit(wide), F.lit(value_group)) if value_group else found
    pieces = F.arrays_zip(gaps.alias("gap"), found.alias("found"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,found:string,value:string>>")
    placed = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, p: let(
            acc["at"] + F.length(p["gap"]),
            lambda start: F.struct(
                (start + F.length(p["found"])).alias("at"),
                F.when(
                    p["found"] != "",
                    F.concat(
                        acc["spans"],
                        F.array(F.struct(start.alias("start"), (start + F.length(p["found"])).alias("end"), p["found"].alias("found"), p["value"].alias("value"))),
                    ),
                )
                .otherwise(acc["spans"])
                .alias("spans"),
            ),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(likely, placed).otherwise(empty)


def _spans(located: Column, kind: str, keep=None) -> Column:
    kept = F.filter(located, keep) if keep else located
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end")))


def _high_runs(candidate: Column, bits: Column) -> Column:
    """Merged runs (start, end) within a string whose windows have more than the given bits per character."""
    scale = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 1)]
    term = lambda n: F.element_at(F.array(*[F.lit(x) for x in scale]), (n + 1).cast("int"))
    run = "struct<start:int,end:int>"
    state = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast(run).alias("open"),
        F.array().cast(f"array<{run}>").alias("closed"),
    )

    def step(codes, most, acc, i):
        new, old = F.get(codes, i), F.get(codes, i - WINDOW)
        leaves = i >= WINDOW
        n_new, n_old = F.get(acc["counts"], new), F.get(acc["counts"], F.coalesce(old, F.lit(0)))
        grown = term(n_new + 1) - term(n_new)
        total = (
            F.when(~leaves, acc["sum"] + grown)
            .when(new == old, acc["sum"])
            .otherwise(acc["sum"] + grown + term(n_old - 1) - term(n_old))
        )
        counts = F.transform(
            acc["counts"], lambda n, k: n + F.when(k == new, 1).otherwise(0) - F.when(leaves & (k == old), 1).otherwise(0)
        )
        first = i - (WINDOW - 1)

        def after(s):
            high = (first >= 0) & (s <= most)
            here = F.struct(first.alias("start"), (i + 1).alias("end"))
            joins = acc["open"].isNotNull() & (first <= acc["open"]["end"])
            return F.struct(
                counts.alias("counts"),
                s.alias("sum"),
                F.when(high & joins, F.struct(acc["open"]["start"].alias("start"), (i + 1).alias("end")))
                .when(high, here)
                .otherwise(acc["open"])
                .alias("open"),
                F.when(high & acc["open"].isNotNull() & ~joins, F.concat(acc["closed"], F.array(acc["open"]))).otherwise(acc["closed"]).alias("closed"),
            )

        return let(total, after)

    # entropy = log2(w) - sum / w, so it is high where the sum is small
    most = WINDOW * (math.log2(WINDOW) - bits) + 1e-9
    return let(
        F.transform(F.split(candidate, ""), lambda c: F.ascii(c)),
        lambda codes: F.aggregate(
            F.sequence(F.lit(0), F.length(candidate) - 1),
            state,
            lambda acc, i: step(codes, most, acc, i),
            lambda acc: F.when(acc["open"].isNull(), acc["closed"]).otherwise(F.concat(acc["closed"], F.array(acc["open"]))),
        ),
    )


def _merged(spans: Column) -> Column:
    """Spans by start, those that overlap or touch as one."""
    span = "struct<start:int,end:int>"
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(f"array<{span}>"),
        lambda acc, s: let(
            F.try_element_at(acc, F.lit(-1)),
            lambda last: F.when(
                last.isNotNull() & (s["start"] <= last["end"]),
                F.concat(
                    F.slice(acc, 1, F.size(acc) - 1),
                    F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
                ),
            ).otherwise(F.concat(acc, F.array(s))),
        ),
    )


def _entropy_spans(text: Column, allowed: tuple[str, ...]) -> Column:
    def is_allowed(part, form="{}"):
        found = F.lit(False)
        for pattern in allowed:
            found = found | part.rlike(form.replace("{}", pattern))
        return found

    def class_runs(s, form, bits, whole):
        # a window cannot reach the bits with fewer different characters than this
        least = math.ceil(2**bits)
        return F.transform(
            F.filter(
                _located(s["found"], form, "entropy", F.lit(True)),
                lambda r: (F.size(F.array_distinct(F.split(r["found"], ""))) >= least) & (~is_allowed(r["found"], "^(?:{})$") if whole else F.lit(True)),
            ),
            lambda r: F.struct((s["start"] + r["start"]).alias("start"), r["found"].alias("found"), F.lit(bits).alias("bits")),
        )

    candidates = _located(text, CANDIDATE, "entropy", text.rlike(CANDIDATE))
    runs = F.flatten(F.transform(candidates, lambda s: F.array_distinct(F.concat(*[class_runs(s, *c) for c in CLASSES]))))
    spans = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                F.filter(
                    _high_runs(r["found"], r["bits"]),
                    lambda h: ~is_allowed(F.substring(r["found"], h["start"] + 1, h["end"] - h["start"])),
                ),
                lambda h: F.struct((r["start"] + h["start"]).alias("start"), (r["start"] + h["end"]).alias("end")),
            ),
        )
    )
    return _spans(_merged(spans), "entropy")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    ``spans`` lists kind:start:end by start, then kind; ``base_sha256`` digests
    the same list without entropy spans. Null and empty texts have no spans.
    Rows repeat as in the input and null ids stay null; an empty table gives no
    rows; further columns are ignored. Narrow: nothing is shuffled.
    """
    text = F.col("body")
    lowered = F.lower(text)
    named = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        named = named | lowered.contains(word)
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), text_or_empty(docs, text_col).alias("body"))
    found = rows.select(
        "doc_id",
        _spans(_located(text, ASSIGN, "assign", named, 3), "assign", lambda s: F.length(s["value"]) >= LEAST_VALUE).alias("assign"),
        _spans(_located(text, ACCESS, "access", text.contains("AKIA")), "access", lambda s: F.length(s["found"]) >= LEAST_ACCESS).alias("access"),
        # a run below the least length never matches, so the bound may stand in the pattern
        _spans(_located(text, HEX[:-1] + "{%d,}" % LEAST_HEX, "hex", text.rlike("[0-9a-f]{%d}" % LEAST_HEX)), "hex").alias("hex"),
        _entropy_spans(text, allowed).alias("entropy"),
    )
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("assign", "access", "hex", "entropy"))).alias("spans"),
    )
