"""HTML entities as characters, inside the JVM and in one pass."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from pricewright.functions.constants import constant_lookup
from pricewright.functions.let import let

# The names of HTML 4 come with the language; a no-break space is shown as a blank.
NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
REPLACEMENT = "�"


def _character(code: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit(REPLACEMENT))


def decode_entities(text: Column) -> Column:
    """Text with decimal, hexadecimal and named entities replaced; unknown names stay as they are.

    Each entity is replaced once, so ``&amp;lt;`` becomes ``&lt;``.
    """

    def decoded(piece: Column) -> Column:
        # a piece is an entity with the text up to the next one, or text alone
        def by(name: Column) -> Column:
            hexadecimal = F.conv(F.substr(name, F.lit(3)), 16, 10).cast("bigint")
            decimal = F.substr(name, F.lit(2)).try_cast("bigint")
            char = (
                F.when(F.lower(name).startswith("#x"), _character(hexadecimal))
                .when(F.startswith(name, F.lit("#")), _character(decimal))
                .otherwise(constant_lookup(name, NAMED, "string"))
            )
            return F.coalesce(F.concat(char, F.substr(piece, F.length(name) + 3)), piece)

        return F.when(piece.rlike("^" + ENTITY), let(F.regexp_extract(piece, "^&([^;]*);", 1), by)).otherwise(piece)

    pieces = F.array_join(F.transform(F.split(text, f"(?={ENTITY})"), decoded), "")
    return F.when(F.contains(text, F.lit("&")), pieces).otherwise(text)
