"""String expressions used while collecting and cleaning listings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed value: the size formats found in listing pages ---------------------
SIZE_PATTERN = (
    r"(ONE SIZE)"
    r"|(\b\d+\.\d+\b)"
    r"|\b(?:US\s)?([34SMLX]+(?:-[A-Z]+)?)\b"
    r"|(\b\d+[SRL]?\b)"
)
# --- end of fixed value ---------------------------------------------------------


def extract_size(text: Column) -> Column:
    """Leftmost size in the text, or the text itself when there is none.

    One regex pass takes the whole match; only the letter branch can carry the
    country prefix, so dropping it afterwards gives the captured group.
    """
    found = F.regexp_extract(text, SIZE_PATTERN, 0)
    return F.when(found == "", text).otherwise(F.regexp_replace(found, r"^US\s", ""))


def listing_id(url: Column) -> Column:
    """First run of digits in a listing URL."""
    return F.regexp_extract(url, "[0-9]+", 0)


def slug(link: Column) -> Column:
    """Last path segment of a link."""
    return F.substring_index(link, "/", -1)


def strip_prefix(text: Column, prefix: str) -> Column:
    """The text without a literal prefix."""
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2_000_000_000)).otherwise(text)


def designer_slug(name: Column) -> Column:
    """Designer name as the site spells it in links."""
    return F.regexp_replace(F.trim(F.lower(name)), r"\s+", "-")


def client_ip(forwarded_for: Column, host: Column) -> Column:
    """First hop of a forwarded-for header, else the peer address."""
    return F.coalesce(F.nullif(F.substring_index(forwarded_for, ",", 1), F.lit("")), host)


def first_token(text: Column) -> Column:
    """First whitespace-separated token (as in a ``srcset`` attribute)."""
    return F.split(F.trim(text), r"\s+")[0]


def error_detail(error: Column, status_code: Column, message: Column) -> Column:
    """One line describing a failed fetch; absent parts are left out."""
    return F.concat_ws(
        " | ",
        F.concat(F.lit("Error type: "), error),
        F.concat(F.lit("Status code: "), status_code.cast("string")),
        F.concat(F.lit("Message: "), message),
    )


def prediction_id(at: Column) -> Column:
    """Second-granular prediction label; not a key under load."""
    return F.concat(F.lit("pred_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def iso_timestamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
