"""Collection and cleaning queries: sizes, links, page fields, routing, validation, archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions import strings as G
from pricewright.operators import lookup as L
from pricewright.operators import quality as Q
from pricewright.operators import select as S
from pricewright.plans.registry import query
from pricewright.schemas import ERROR_CAUSE
from pricewright.sources.writers import only_new
from pricewright.vocab import CONDITIONS, SIZES, SUBCATEGORIES, size_options, subcategory_options

SIZE_TEXT_SQL = """
  SELECT p_partkey, CASE p_size % 7
    WHEN 0 THEN 'Women''s / ONE SIZE' WHEN 1 THEN 'Women''s / XXS / US 00 / IT 34'
    WHEN 2 THEN 'Women''s / 3XL / US ' || p_size || '-22' WHEN 3 THEN 'Men''s / US ' || p_size || ' / EU 44'
    WHEN 4 THEN 'Men''s / US ' || p_size || '.5 / EU 43-44' WHEN 5 THEN 'Men''s / ' || p_size || 'R'
    ELSE 'no size given' END AS size,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS hashtags FROM part"""

SIZE_SQL = r"""
  coalesce(nullif(regexp_extract(size, p, 1), ''), nullif(regexp_extract(size, p, 2), ''),
           nullif(regexp_extract(size, p, 3), ''), nullif(regexp_extract(size, p, 4), ''), size)"""


def size_texts(t):
    return t.table("part").selectExpr(
        "p_partkey",
        """CASE p_size % 7
    WHEN 0 THEN "Women's / ONE SIZE" WHEN 1 THEN "Women's / XXS / US 00 / IT 34"
    WHEN 2 THEN concat("Women's / 3XL / US ", p_size, '-22') WHEN 3 THEN concat("Men's / US ", p_size, ' / EU 44')
    WHEN 4 THEN concat("Men's / US ", p_size, '.5 / EU 43-44') WHEN 5 THEN concat("Men's / ", p_size, 'R')
    ELSE 'no size given' END AS size""",
        "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS hashtags",
    )


@query(
    "cleaned_batch",
    "STR-1 DQ4 PRJ4",
    "WITH s AS (SELECT *, '" + G.SIZE_PATTERN + "' AS p FROM (" + SIZE_TEXT_SQL + "))"
    + " SELECT p_partkey, " + SIZE_SQL + " AS size, coalesce(hashtags, 'missing') AS hashtags FROM s",
)
def cleaned_batch(t):
    return S.transform_listings(size_texts(t))


@query(
    "page_links",
    "STR-8 STR-9",
    r"""SELECT page_id, regexp_extract(url, '[0-9]+', 0) AS listing_id, split_part(url, '/', -1) AS slug FROM pages""",
)
def page_links(t):
    return t.pages().select(
        "page_id", G.listing_id(F.col("url")).alias("listing_id"), G.slug(F.col("url")).alias("slug")
    )


@query(
    "string_helpers",
    "STR-10 STR-11 STR-13",
    r"""SELECT c_custkey, CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) ELSE c_name END AS number,
              regexp_replace(trim(lower('  ' || c_mktsegment || '  ' || c_name || ' ')), '\s+', '-', 'g') AS designer,
              string_split_regex(trim(c_name || ' 480w, x.webp 960w'), '\s+')[1] AS first_source FROM customer""",
)
def string_helpers(t):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.table("customer").select(
        "c_custkey",
        G.strip_prefix(name, "Customer#").alias("number"),
        G.designer_slug(F.concat(F.lit("  "), segment, F.lit("  "), name, F.lit(" "))).alias("designer"),
        G.first_token(F.concat(name, F.lit(" 480w, x.webp 960w"))).alias("first_source"),
    )


@query(
    "request_addresses",
    "STR-12 STR-14 STR-15",
    r"""SELECT event_id,
              coalesce(nullif(split_part(CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN user_id || '.1, 9.9' END, ',', 1), ''),
                       'host' || user_id) AS client_ip,
              concat_ws(' | ', 'Error type: ' || event_type,
                        'Status code: ' || CASE WHEN event_id % 2 = 0 THEN 500 END,
                        'Message: ' || CASE WHEN event_id % 5 = 0 THEN props END) AS detail,
              'pred_' || strftime(ts, '%Y%m%d_%H%M%S') AS prediction_id,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS prediction_timestamp
       FROM events""",
)
def request_addresses(t):
    user, k = F.col("user_id").cast("string"), F.col("event_id")
    forwarded = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(user, F.lit(".1, 9.9")))
    at = F.col("ts").cast("timestamp")
    return t.table("events").select(
        "event_id",
        G.client_ip(forwarded, F.concat(F.lit("host"), user)).alias("client_ip"),
        G.error_detail(F.col("event_type"), F.when(k % 2 == 0, 500), F.when(k % 5 == 0, F.col("props"))).alias("detail"),
        G.prediction_id(at).alias("prediction_id"),
        G.iso_timestamp(at).alias("prediction_timestamp"),
    )


PAGE_SPEC = [
    Q.Field("title", Q.element_pattern("h1")),
    Q.Field("body", Q.element_pattern("p"), "join"),
    Q.Field("n_links", Q.link_pattern(), "count"),
    Q.Field("first_link", Q.link_pattern(), 0, link=True),
    Q.Field("fourth_link", Q.link_pattern(), 3, link=True),
    Q.Field("tag_links", Q.link_pattern("zz", "a"), "join", prefix="/", required=False),
]


# The entities that the stored pages hold, ampersand last.
PAGE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
                 ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def _text_sql(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, char in PAGE_ENTITIES:
        out = f"replace({out}, '{entity}', '" + char.replace("'", "''") + "')"
    return out


@query(
    "page_fields",
    "DQ1",
    r"""WITH m AS (SELECT page_id, html, regexp_extract_all(html, '<[a-zA-Z]+\s[^>]*href="([^"]*)"', 1) AS links,
                     regexp_extract_all(html, '(?s)<h1(?:\s[^>]*)?>(.*?)</h1>', 1) AS h1,
                     regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1) AS ps FROM pages)
       SELECT page_id, """ + _text_sql("h1[1]") + r""" AS title,
              md5(array_to_string(list_transform(ps, lambda x: """ + _text_sql("x") + r"""), ' ')) AS body_md5,
              len(links) AS n_links, split_part(replace(links[1], '&amp;', '&'), '/', -1) AS first_link,
              split_part(replace(links[4], '&amp;', '&'), '/', -1) AS fourth_link,
              nullif(array_to_string(list_transform(list_filter(links, lambda x: contains(x, 'zz')),
                     lambda x: regexp_replace(x, '^/', '')), ' '), '') AS tag_links FROM m""",
)
def page_fields(t):
    out = Q.extract_fields(t.pages(), PAGE_SPEC)
    return out.select(
        "page_id", "title", F.md5("body").alias("body_md5"), F.col("n_links").cast("long").alias("n_links"),
        "first_link", "fourth_link", "tag_links",
    )


@query(
    "listing_page_errors",
    "DQ1 DQ2",
    """SELECT regexp_extract(url, '[0-9]+', 0) AS id, 'listing' AS error_source, 'MissingField' AS error, count(*) AS n
       FROM pages GROUP BY 1""",
)
def listing_page_errors(t):
    rows = Q.extract_listings(t.pages()).withColumns(
        {"parsing_date": F.lit(None).cast("date"), "image_error": F.lit(None).cast(ERROR_CAUSE)}
    )
    _, errors = Q.route_errors(rows)
    return errors.groupBy("id", "error_source", F.col("error_cause.error").alias("error")).agg(F.count("*").alias("n"))


def listing_pages(t) -> DataFrame:
    """A listing page for every document: either quote, entities of all kinds, look-alike tags, absent parts."""
    k, quote = F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, "'").otherwise('"')
    number = k.cast("string")

    def tag(name: str, css: str, inside) -> Column:
        return F.concat(F.lit(f"<{name} data-x=1 class="), quote, F.lit(css), quote, F.lit(">"), inside, F.lit(f"</{name}>\n"))

    def link(target) -> Column:
        return F.concat(F.lit("<a class=q href="), quote, target, quote, F.lit(">x</a>\n"))

    escaped = F.coalesce("text", F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    designer = F.concat(F.lit("/designers/"), F.col("source"))
    none = F.lit("")
    html = F.concat(
        link(designer), link(F.concat(designer, F.lit("/menswear"))), link(F.concat(designer, F.lit("/tops"))),
        link(F.concat(designer, F.lit("?a=1&amp;b=/"), F.col("lang"))),
        F.repeat(tag("button", Q.PHOTO_CLASS, none), (k % 5 + 1).cast("int")),
        tag("h1", Q.TITLE_CLASS, F.concat(F.lit("Caf&#233; &amp;amp; <b>No</b> &#x1F600;&eacute;&unknown; "), number)),
        tag("path", Q.DETAIL_CLASS, F.lit("Size wrong")), tag("pre", Q.PARAGRAPH_CLASS, F.lit("wrong")),
        tag("p", Q.DETAIL_CLASS, F.concat(F.lit("Size Men&#39;s / US "), (k % 40).cast("string"))),
        tag("p", Q.DETAIL_CLASS, F.concat(F.lit("Color <i>"), F.col("lang"), F.lit("</i>"))),
        F.when(k % 7 == 0, none).otherwise(tag("p", Q.DETAIL_CLASS, F.lit("Condition Gently Used"))),
        tag("p", Q.PARAGRAPH_CLASS, escaped), tag("p", Q.PARAGRAPH_CLASS, F.lit("end &#8364;")),
        F.when(k % 3 == 0, none).otherwise(F.concat(link(F.lit("/shop?hashtag=one")), link(F.lit("/shop?hashtag=two")))),
        F.when(k % 11 == 0, none).otherwise(tag("span", "Money SoldPrice_x", F.concat(F.lit("$"), (k % 900 + 20).cast("string")))),
    )
    return t.table("documents").select("doc_id", F.concat(F.lit("https://x.example/listings/"), number, F.lit("-a")).alias("url"), html.alias("html"))


@query(
    "listing_page_values",
    "DQ1",
    """SELECT CAST(doc_id AS VARCHAR) AS id, source AS designer, 'menswear' AS department, 'tops' AS category, lang AS subcategory,
              CAST(doc_id % 5 + 1 AS INTEGER) AS n_photos, 'Café &amp; No 😀é&unknown; ' || doc_id AS item_name,
              'Men''s / US ' || (doc_id % 40) AS size, lang AS color, CASE WHEN doc_id % 7 <> 0 THEN 'Gently Used' END AS condition,
              md5(coalesce(text, '') || ' end €') AS description_md5, CASE WHEN doc_id % 3 <> 0 THEN 'one two' END AS hashtags,
              CASE WHEN doc_id % 11 <> 0 THEN CAST(doc_id % 900 + 20 AS INTEGER) END AS sold_price,
              CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'Failed to scrape listing data: ' ||
                   concat_ws(', ', CASE WHEN doc_id % 7 = 0 THEN 'condition' END, CASE WHEN doc_id % 11 = 0 THEN 'sold_price' END) END AS message
       FROM documents""",
)
def listing_page_values(t):
    """All twelve fields of pages with whole texts, and the reasons of the pages that fail."""
    return Q.extract_listings(listing_pages(t)).select(
        "id", "designer", "department", "category", "subcategory", "n_photos", "item_name", "size", "color", "condition",
        F.md5("description").alias("description_md5"), "hashtags", "sold_price", F.col("listing_error.message").alias("message"),
    )


def fetched(t):
    """Pages as fetch outcomes: every seventh listing and every eleventh image failed."""
    k = F.col("page_id")

    def failure(step: int, code: int):
        return F.when(
            k % step == 0,
            F.struct(
                F.lit("HTTPError").alias("error"), F.lit(code).alias("status_code"), F.lit(None).cast("string").alias("message")
            ).cast(ERROR_CAUSE),
        )

    return t.pages().select(
        k.cast("string").alias("id"),
        F.lit("2024-01-01").cast("date").alias("parsing_date"),
        "url",
        failure(7, 404).alias("listing_error"),
        failure(11, 503).alias("image_error"),
    )


@query(
    "routed_errors",
    "DQ2",
    """SELECT CAST(page_id AS VARCHAR) AS id, 'listing' AS error_source, 'HTTPError' AS error, 404 AS status_code
       FROM pages WHERE page_id % 7 = 0
       UNION ALL SELECT CAST(page_id AS VARCHAR), 'image', 'HTTPError', 503 FROM pages WHERE page_id % 11 = 0""",
)
def routed_errors(t):
    _, errors = Q.route_errors(fetched(t))
    return errors.select("id", "error_source", "error_cause.error", "error_cause.status_code")


@query(
    "routed_listings",
    "DQ2",
    "SELECT CAST(page_id AS VARCHAR) AS id, url FROM pages WHERE page_id % 7 <> 0 AND page_id % 11 <> 0",
)
def routed_listings(t):
    ok, _ = Q.route_errors(fetched(t))
    return ok.select("id", "url")


def _sql_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in sorted(set(values))) + ")"


PAIRS = [(d, c) for d, cats in SUBCATEGORIES.items() for c in cats]
ALL_CATEGORIES = [c for _, c in PAIRS]
ALL_SUBCATEGORIES = [s for d, c in PAIRS for s in SUBCATEGORIES[d][c]]
ALL_SIZES = [s for d, c in PAIRS for s in SIZES[d][c]]

# Site vocabulary over the driver tables, with some values that are not offered.
OFFERS_SQL = """(
  SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'womenswear' ELSE 'menswear' END AS department,
         ['tops', 'bottoms', 'footwear', 'dresses', 'hats'][doc_id % 5 + 1] AS category,
         ['polos', 'shorts', 'boots', 'gowns', 'denim', 'anything'][doc_id % 6 + 1] AS subcategory,
         ['New', 'Used', 'Torn'][doc_id % 3 + 1] AS condition, CAST(p_size AS VARCHAR) AS size, p_brand AS designer,
         CASE WHEN doc_id % 9 = 0 THEN '' ELSE p_name END AS color, CAST(doc_id % 30 AS INTEGER) AS n_photos,
         substr(text, 1, CAST(40 + doc_id % 40 AS INTEGER)) AS item_name, text AS description,
         CASE WHEN doc_id % 4 = 0 THEN NULL ELSE substr(text, 1, 80) END AS hashtags
  FROM documents JOIN part ON doc_id = p_partkey)"""


def offers(t):
    k = F.col("doc_id")

    def pick(*options):
        return F.element_at(F.array(*map(F.lit, options)), (k % len(options) + 1).cast("int"))

    return (
        t.table("documents")
        .join(t.table("part"), k == F.col("p_partkey"))
        .select(
            k.alias("id"),
            F.when(k % 3 == 0, "womenswear").otherwise("menswear").alias("department"),
            pick("tops", "bottoms", "footwear", "dresses", "hats").alias("category"),
            pick("polos", "shorts", "boots", "gowns", "denim", "anything").alias("subcategory"),
            pick("New", "Used", "Torn").alias("condition"),
            F.col("p_size").cast("string").alias("size"),
            F.col("p_brand").alias("designer"),
            F.when(k % 9 == 0, "").otherwise(F.col("p_name")).alias("color"),
            (k % 30).cast("int").alias("n_photos"),
            F.substr("text", F.lit(1), (40 + k % 40).cast("int")).alias("item_name"),
            F.col("text").alias("description"),
            F.when(k % 4 != 0, F.substring("text", 1, 80)).alias("hashtags"),
        )
    )


def _violations_sql(extra_sub: str = "", extra_size: str = "") -> str:
    return rf"""array_to_string(list_filter([
      CASE WHEN department NOT IN {_sql_list(SUBCATEGORIES)} THEN 'department' END,
      CASE WHEN category NOT IN {_sql_list(ALL_CATEGORIES)} THEN 'category' END,
      CASE WHEN subcategory NOT IN {_sql_list(ALL_SUBCATEGORIES)} {extra_sub} THEN 'subcategory' END,
      CASE WHEN condition NOT IN {_sql_list(CONDITIONS)} THEN 'condition' END,
      CASE WHEN size NOT IN {_sql_list(ALL_SIZES)} {extra_size} THEN 'size' END,
      CASE WHEN length(designer) < 1 THEN 'designer' END, CASE WHEN length(color) < 1 THEN 'color' END,
      CASE WHEN n_photos NOT BETWEEN 1 AND 25 THEN 'n_photos' END,
      CASE WHEN length(item_name) NOT BETWEEN 1 AND 60 THEN 'item_name' END,
      CASE WHEN length(description) < 1 THEN 'description' END,
      CASE WHEN len(list_filter(regexp_split_to_array(hashtags, '\s+'), lambda w: w <> '')) > 10 THEN 'hashtags' END
      ], lambda v: v IS NOT NULL), ',')"""


@query(
    "validated_offers",
    "DQ3",
    f"SELECT id, {_violations_sql()} AS violations FROM {OFFERS_SQL}",
)
def validated_offers(t):
    return Q.validate(offers(t)).select("id", F.array_join("violations", ",").alias("violations"))


def _dimension_sql(table: dict, column: str) -> str:
    rows = []
    for dep, cats in table.items():
        for cat, options in cats.items():
            for option in options.split() if isinstance(options, str) else options:
                rows.append(f"('{dep}', '{cat}', '{option}')")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS v(department, category, {column}))"


@query(
    "validated_dependent_offers",
    "DQ3 JOI6",
    f"""WITH s AS {_dimension_sql(SUBCATEGORIES, 'subcategory')}, z AS {_dimension_sql(SIZES, 'size')}, o AS {OFFERS_SQL}
        SELECT id, {_violations_sql(
            "OR NOT EXISTS (SELECT 1 FROM s WHERE s.department = o.department AND s.category = o.category AND s.subcategory = o.subcategory)",
            "OR NOT EXISTS (SELECT 1 FROM z WHERE z.department = o.department AND z.category = o.category AND z.size = o.size)")}
        AS violations FROM o""",
)
def validated_dependent_offers(t):
    return Q.validate(offers(t), dependent=True).select("id", F.array_join("violations", ",").alias("violations"))


@query(
    "offered_subcategories",
    "JOI6",
    f"""WITH s AS {_dimension_sql(SUBCATEGORIES, 'subcategory')}, o AS {OFFERS_SQL}
        SELECT id, s.category IS NOT NULL AS is_option FROM o LEFT JOIN s USING (department, category, subcategory)""",
)
def offered_subcategories(t):
    out = L.check_options(offers(t), subcategory_options(t.spark), ["department", "category", "subcategory"])
    return out.select("id", "is_option")


@query(
    "offered_sizes",
    "JOI6",
    f"""WITH z AS {_dimension_sql(SIZES, 'size')}, o AS {OFFERS_SQL}
        SELECT o.id FROM o SEMI JOIN z ON o.department = z.department AND o.category = z.category AND o.size = z.size""",
)
def offered_sizes(t):
    out = L.check_options(offers(t), size_options(t.spark), ["department", "category", "size"])
    return out.where("is_option").select("id")


@query(
    "new_images",
    "JOI3 SNK4",
    """SELECT doc_id || '.webp' AS name, md5(text) AS content FROM documents WHERE doc_id % 2 = 1""",
)
def new_images(t):
    images = t.images()
    archived = images.where(F.col("doc_id") % 2 == 0)
    return only_new(images.drop("doc_id"), archived, "name")


@query(
    "appended_batch",
    "SNK3 SET2",
    """SELECT o_orderkey, o_totalprice FROM orders""",
)
def appended_batch(t):
    """Existing rows and a batch that repeats half of them: ids already stored are left out."""
    rows = t.table("orders").select("o_orderkey", "o_totalprice")
    stored = rows.where(F.col("o_orderkey") % 2 == 0)
    return stored.unionByName(only_new(rows, stored, "o_orderkey"))


@query(
    "paired_parts",
    "JOI4",
    """SELECT doc_id, n_chars, CAST(strlen(text) AS BIGINT) AS bytes FROM documents""",
)
def paired_parts(t):
    rows = t.table("documents")
    return L.pair_strict(
        rows.select("doc_id", "n_chars"),
        rows.select("doc_id", F.octet_length("text").cast("long").alias("bytes")),
        "doc_id",
    )
