"""Text cleaning, tokens, n-grams and statistics as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pricewright.functions.constants import constant_lookup, in_constant
from pricewright.functions.let import let
from pricewright.vocab import IRREGULAR_NOUNS, PLACEHOLDER, STOP_WORDS

# Characters that stand alone as tokens in treebank-style tokenisation.
SEPARATORS = r"[;@#$%&?!()\[\]{}<>\"“”«»…]+|--+"
COMMA_OR_COLON = r"[:,]([^0-9]|$)"
# Punctuation that is not between two letters or digits. The possessive runs keep
# every pass linear, however long a token is.
EDGES = r"(?<![\p{L}\p{N}])[^\p{L}\p{N}\s]++|[^\p{L}\p{N}\s]++(?![\p{L}\p{N}])"
CLITIC = r"['’](s|re|ve|ll|d|m)(?!\S)"
# Whole tokens with a character outside the kept class.
REJECT = {
    "alnum": r"(?<!\S)[\p{L}\p{N}]*+[^\p{L}\p{N}\s]\S*+",
    "alpha": r"(?<!\S)\p{L}*+[^\p{L}\s]\S*+",
}


def words(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def normalize(text: Column) -> Column:
    """Lower-cased text without separators, punctuation at token edges and clitics."""
    spaced = F.regexp_replace(F.lower(text), SEPARATORS, " ")
    spaced = F.regexp_replace(spaced, COMMA_OR_COLON, " $1")
    return F.regexp_replace(F.regexp_replace(spaced, EDGES, ""), CLITIC, "")


def tokenize(text: Column) -> Column:
    return words(normalize(text))


def singular(token: Column, lemmas: dict[str, str] | None = None) -> Column:
    """Noun lemma: the lemma table where it knows the word, else the plural suffix rules."""
    n = F.length(token)

    def cut(k: int, tail: str = "") -> Column:
        stem = F.substr(token, F.lit(1), n - k)
        return F.concat(stem, F.lit(tail)) if tail else stem

    return F.coalesce(
        constant_lookup(token, IRREGULAR_NOUNS if lemmas is None else lemmas, "string"),
        F.when((n < 4) | ~F.endswith(token, F.lit("s")), token)
        .when(token.rlike("(ss|us|is)$"), token)
        .when(token.rlike("(ch|sh|x|z|ss)es$"), cut(2))
        .when(F.endswith(token, F.lit("ies")) & (n > 4), cut(3, "y"))
        .otherwise(cut(1)),
    )


def clean_tokens(
    text: Column, keep: str = "alnum", stop_words=STOP_WORDS, lemmas: dict[str, str] | None = None
) -> Column:
    """Content-word lemmas in reading order; the stop list and lemma table can be replaced."""
    if keep not in REJECT:
        raise ValueError(f"keep must be one of {sorted(REJECT)}, not {keep!r}")
    candidates = words(F.regexp_replace(normalize(text), REJECT[keep], " "))
    kept = F.filter(candidates, lambda w: ~in_constant(w, stop_words))
    return F.transform(kept, lambda w: singular(w, lemmas))


def clean_text(text: Column, placeholder: str = PLACEHOLDER, keep: str = "alnum", **tables) -> Column:
    """Cleaned text, or the placeholder where nothing is left of it."""
    joined = F.array_join(clean_tokens(text, keep, **tables), " ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(placeholder))


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of n tokens; empty when there are fewer than n."""
    if n == 1:
        return tokens

    def runs(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(t) - (n - 1))
        joined = F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.element_at(t, (i + k).cast("int")) for k in range(n)])
        )
        return F.when(F.size(t) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(tokens, runs)


def vector_tokens(text: Column) -> Column:
    """Vocabulary tokens: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def text_stats(text: Column, placeholder: str = PLACEHOLDER) -> Column:
    """Model statistics; spaces count towards the average word length."""
    present = text.isNotNull() & (text != placeholder)
    length = F.when(present, F.length(text)).otherwise(0)
    return let(
        F.when(present, F.size(words(text))).otherwise(0),
        lambda count: F.struct(
            F.when(count > 0, length / count).otherwise(F.lit(0.0)).alias("avg_word_length"),
            length.alias("length"),
            count.alias("num_words"),
        ),
    )


def text_stats_eda(text: Column) -> Column:
    """Exploration statistics; the average is the mean length of the words."""

    def stats(w: Column) -> Column:
        total = F.aggregate(w, F.lit(0), lambda acc, x: acc + F.length(x))
        return F.struct(
            F.length(text).alias("char_count"),
            F.size(w).alias("word_count"),
            F.when(F.size(w) > 0, total / F.size(w)).otherwise(F.lit(0.0)).alias("avg_word_length"),
        )

    return let(words(text), stats)


def is_missing(text: Column, placeholder: str = PLACEHOLDER) -> Column:
    return (text.eqNullSafe(F.lit(placeholder))).cast("int")
