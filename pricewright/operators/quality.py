"""Page extraction, error routing and validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.entities import decode_entities
from pricewright.functions.strings import listing_id, slug, strip_prefix
from pricewright.functions.text import words
from pricewright.operators.lookup import check_options
from pricewright.schemas import ERROR_CAUSE
from pricewright.vocab import (
    CONDITIONS,
    MAX_HASHTAGS,
    MAX_ITEM_NAME,
    MAX_PHOTOS,
    SIZES,
    SUBCATEGORIES,
    size_options,
    subcategory_options,
)

# --- fixed values: markup of the listing page -----------------------------------
TITLE_CLASS = "Body_body__dIg1V Text Details_title__PpX5v"
PARAGRAPH_CLASS = "Body_body__dIg1V Text Description_paragraph__Gs7y6"
DETAIL_CLASS = "Body_body__dIg1V Text Details_detail__J0Uny Details_nonMobile__AObqX"
PHOTO_CLASS = "Button_button__30ukX"
PRICE_CLASS_PART = "SoldPrice"
DESIGNER_LINK_PART = "/designers/"
HASHTAG_LINK_PART = "hashtag"
HASHTAG_PREFIX = "/shop?hashtag="
# --- end of fixed values ----------------------------------------------------------


def strip_markup(fragment: Column) -> Column:
    """Text of an HTML fragment: tags dropped, entities replaced."""
    return decode_entities(F.regexp_replace(fragment, r"<[^>]*>", ""))


def _class(name: str, part: bool = False) -> str:
    """Regex of a class attribute in quotes of either kind."""
    double, single = ('[^"]*', "[^']*") if part else ("", "")
    return rf"""\sclass=(?:"{double}{name}{double}"|'{single}{name}{single}')"""


def element_pattern(tag: str, class_name: str | None = None, class_part: str | None = None) -> str:
    """Regex for the inside of an element, optionally by whole class or part of it."""
    if class_name is not None:
        attributes = rf"(?=\s)[^>]*{_class(class_name)}[^>]*"
    elif class_part is not None:
        attributes = rf"(?=\s)[^>]*{_class(class_part, part=True)}[^>]*"
    else:
        attributes = r"(?:\s[^>]*)?"
    return rf"(?s)<{tag}{attributes}>(.*?)</{tag}>"


def link_pattern(part: str = "", tag: str = r"[a-zA-Z]+") -> str:
    """Regex for the target of a link, in quotes of either kind."""
    return rf"""<{tag}\s[^>]*href=["']((?<=")[^"]*{part}[^"]*(?=")|(?<=')[^']*{part}[^']*(?='))["']"""


@dataclass(frozen=True)
class Field:
    """One extracted field: where it is and how its matches become a value.

    ``take`` is first, join (space-joined), count, or an index of the matches.
    ``link`` keeps the last path segment. A required field without a match makes
    the page an error row.
    """

    name: str
    pattern: str
    take: str | int = "first"
    link: bool = False
    prefix: str = ""
    containing: str = ""
    required: bool = True
    cast: str = "string"


def _matches(source: Column, field: Field) -> Column:
    found = F.regexp_extract_all(source, F.lit(field.pattern), F.lit(1))
    if field.link or "href" in field.pattern:
        found = F.transform(found, decode_entities)
    else:
        found = F.transform(found, lambda m: strip_markup(m))
    if field.containing:
        found = F.filter(found, lambda m: F.contains(m, F.lit(field.containing)))
    if field.link:
        found = F.transform(found, lambda m: slug(m))
    if field.prefix:
        found = F.transform(found, lambda m: strip_prefix(m, field.prefix))
    return found


def field_value(source: Column, field: Field) -> Column:
    if field.take == "count":
        return F.regexp_count(source, F.lit(field.pattern))
    found = _matches(source, field)
    if field.take == "join":
        value = F.when(F.size(found) > 0, F.array_join(found, " "))
        # an empty list of optional parts is NULL, of required ones an empty text
        return F.coalesce(value, F.lit("")) if field.required else value
    index = 0 if field.take == "first" else int(field.take)
    value = F.get(found, F.lit(index))
    return value if field.cast == "string" else value.try_cast(field.cast)


def listing_spec(sold: bool = True) -> list[Field]:
    designer_links = link_pattern(DESIGNER_LINK_PART)
    detail = element_pattern("p", DETAIL_CLASS)
    fields = [
        Field("designer", designer_links, 0, link=True),
        Field("department", designer_links, 1, link=True),
        Field("category", designer_links, 2, link=True),
        Field("subcategory", designer_links, 3, link=True),
        Field("n_photos", rf"<button(?=\s)[^>]*{_class(PHOTO_CLASS)}", "count", cast="int"),
        Field("item_name", element_pattern("h1", TITLE_CLASS)),
        Field("size", detail, containing="Size", prefix="Size "),
        Field("color", detail, containing="Color", prefix="Color "),
        Field("condition", detail, containing="Condition", prefix="Condition "),
        Field("description", element_pattern("p", PARAGRAPH_CLASS), "join"),
        Field("hashtags", link_pattern(HASHTAG_LINK_PART, "a"), "join", prefix=HASHTAG_PREFIX, required=False),
    ]
    if sold:
        fields.append(Field("sold_price", element_pattern("span", class_part=PRICE_CLASS_PART), prefix="$", cast="int"))
    return fields


def extract_fields(pages: DataFrame, spec: list[Field], html_column: str = "html") -> DataFrame:
    """Add the fields of the spec and a ``listing_error`` naming what was not found."""
    source = F.col(html_column)
    out = pages.withColumns({f.name: field_value(source, f) for f in spec})
    needed = [f.name for f in spec if f.required and f.take not in ("count", "join")]
    absent = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in needed]))
    error = F.struct(
        F.lit("MissingField").alias("error"),
        F.lit(None).cast("int").alias("status_code"),
        F.concat(F.lit("Failed to scrape listing data: "), F.array_join(absent, ", ")).alias("message"),
    ).cast(ERROR_CAUSE)
    return out.withColumn("listing_error", F.when(F.size(absent) > 0, error) if needed else F.lit(None).cast(ERROR_CAUSE))


def extract_listings(pages: DataFrame, sold: bool = True, url: str = "url", html_column: str = "html") -> DataFrame:
    """Listing rows out of stored pages."""
    return extract_fields(pages.withColumn("id", listing_id(F.col(url))), listing_spec(sold), html_column)


def route_errors(df: DataFrame, listing_error: str = "listing_error", image_error: str = "image_error") -> tuple[DataFrame, DataFrame]:
    """(complete rows, error rows): one error row for each failed part of a row."""
    ok = df.where(F.col(listing_error).isNull() & F.col(image_error).isNull()).drop(listing_error, image_error)
    parts = F.array(
        *[
            F.struct(F.lit(source).alias("error_source"), F.col(column).cast(ERROR_CAUSE).alias("error_cause"))
            for source, column in (("listing", listing_error), ("image", image_error))
        ]
    )
    failed = F.filter(parts, lambda p: p["error_cause"].isNotNull())
    errors = df.select("id", "parsing_date", F.explode(failed).alias("p")).select("id", "parsing_date", "p.*")
    return ok, errors


def _one_of(column: str, options) -> Column:
    return ~F.coalesce(F.col(column).isin(*sorted(set(options))), F.lit(False))


def _length(column: str, longest: int | None = None) -> Column:
    n = F.length(column)
    ok = n >= 1 if longest is None else n.between(1, longest)
    return ~F.coalesce(ok, F.lit(False))


def validate(df: DataFrame, dependent: bool = False) -> DataFrame:
    """Add ``violations``: the names of the fields that break a listing rule.

    With ``dependent`` the subcategory and size must also be offered for the
    chosen department and category.
    """
    pairs = [(dep, cat) for dep, cats in SUBCATEGORIES.items() for cat in cats]
    broken = {
        "department": _one_of("department", SUBCATEGORIES),
        "category": _one_of("category", [c for _, c in pairs]),
        "subcategory": _one_of("subcategory", [s for d, c in pairs for s in SUBCATEGORIES[d][c]]),
        "condition": _one_of("condition", CONDITIONS),
        "size": _one_of("size", [s for d, c in pairs for s in SIZES[d][c]]),
        "designer": _length("designer"),
        "color": _length("color"),
        "n_photos": ~F.coalesce(F.col("n_photos").between(1, MAX_PHOTOS), F.lit(False)),
        "item_name": _length("item_name", MAX_ITEM_NAME),
        "description": _length("description"),
        "hashtags": F.coalesce(F.size(words(F.col("hashtags"))) > MAX_HASHTAGS, F.lit(False)),
    }
    columns = df.columns
    if dependent:
        df = check_options(df, subcategory_options(df.sparkSession), ["department", "category", "subcategory"], "__sub")
        df = check_options(df, size_options(df.sparkSession), ["department", "category", "size"], "__size")
        broken["subcategory"] = broken["subcategory"] | ~F.col("__sub")
        broken["size"] = broken["size"] | ~F.col("__size")
    named = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in broken.items()]))
    return df.select(*columns, named.alias("violations"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    return df.where(F.size("violations") == 0).drop("violations"), df.where(F.size("violations") > 0)
