"""SQL twins of the text expressions, written for the checking engine.

Each placeholder becomes a list-valued expression over a column called ``txt``.
"""

from __future__ import annotations

from pricewright.vocab import IRREGULAR_NOUNS, STOP_WORDS


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


_TOKENS = (
    "list_filter(list_transform(list_filter(regexp_split_to_array("
    "regexp_replace(regexp_replace(lower(txt), '[;@#$%&?!()\\[\\]{}<>\"“”«»…]+|--+', ' ', 'g'), "
    "'[:,]([^0-9]|$)', ' \\1', 'g'), '\\s+'), lambda w: w <> ''), "
    "lambda w: regexp_replace(regexp_replace(w, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g'), "
    "'[''’](s|re|ve|ll|d|m)$', '')), lambda w: w <> '')"
)

_IRREGULAR = "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR_NOUNS.items()) + " END"

_PLURAL_RULES = (
    "WHEN length(w) < 4 OR right(w, 1) <> 's' THEN w "
    "WHEN right(w, 2) IN ('ss', 'us', 'is') THEN w "
    "WHEN right(w, 4) IN ('ches', 'shes', 'sses') OR right(w, 3) IN ('xes', 'zes') THEN left(w, length(w) - 2) "
    "WHEN right(w, 3) = 'ies' AND length(w) > 4 THEN left(w, length(w) - 3) || 'y' "
    "ELSE left(w, length(w) - 1) END"
)
_SINGULAR = f"CASE WHEN list_contains({_list(IRREGULAR_NOUNS)}, w) THEN {_IRREGULAR} {_PLURAL_RULES}"


def clean_tokens_sql(keep: str) -> str:
    pattern = {"alnum": "[\\p{L}\\p{N}]+", "alpha": "\\p{L}+"}[keep]
    return (
        f"list_transform(list_filter({_TOKENS}, lambda w: regexp_full_match(w, '{pattern}') "
        f"AND NOT list_contains({_list(STOP_WORDS)}, w)), lambda w: {_SINGULAR})"
    )


TEXT_MACROS = {
    "{all_tokens}": _TOKENS,
    "{alnum_tokens}": clean_tokens_sql("alnum"),
    "{alpha_tokens}": clean_tokens_sql("alpha"),
    "{alnum_words}": f"list_filter({_TOKENS}, lambda w: regexp_full_match(w, '[\\p{{L}}\\p{{N}}]+'))",
    "{singular}": f"CASE {_PLURAL_RULES}",
    "{vector_tokens}": "regexp_extract_all(lower(txt), '[\\p{L}\\p{N}_]{2,}')",
}
