"""Text expressions: blank test, trimming, quote-aware CSV splitting.

All of them are built-in Spark expressions whose cost grows linearly with the line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A text line never contains a line feed, so it can separate fields inside one.
FIELD_BREAK = "\n"

# One separating comma and the token before it. A comma separates when an even number of
# double quotes follows it. Quoted parts are consumed as units; on a line with an odd
# number of quotes the text up to the first quote belongs to the first token, so that the
# quotes that remain pair up.
_ODD_QUOTES_AHEAD = r'(?=[^"]*+"(?:[^"]*+"[^"]*+")*+[^"]*+\z)'
_TOKEN_AND_COMMA = (
    r"\G((?:\A" + _ODD_QUOTES_AHEAD + r'[^"]*+")?+(?:[^",]++|"[^"]*+")*+),'
)


def is_blank(text: Column) -> Column:
    """True when the text is null or holds nothing but blanks and control characters."""
    return ~F.coalesce(text.rlike(r"[^\x00-\x20]"), F.lit(False))


def trim_text(text: Column) -> Column:
    """Remove blanks and control characters from both ends (not only spaces)."""
    return F.regexp_extract(text, r"(?s)\A[\x00-\x20]*+(.*[^\x00-\x20])?", 1)


def csv_tokens(line: Column) -> Column:
    """Split a line on commas outside double quotes, keeping the quotes.

    Empty tokens at the end are dropped. One scan over the line; lines are not limited in
    length.
    """
    kept = F.rtrim(line, F.lit(","))
    marked = F.regexp_replace(kept, _TOKEN_AND_COMMA, "$1" + FIELD_BREAK)
    return F.when(F.contains(line, F.lit('"')), F.split(marked, FIELD_BREAK)).otherwise(F.split(kept, ","))


def evaluate_once(value: Column) -> Column:
    """Yield ``value`` as a generated column, so that later steps reuse the result.

    Filters and projections on an ordinary alias are merged with its definition, which
    would repeat an expensive expression in each of them. The row count is unchanged.
    """
    return F.explode(F.array(value))


def evaluate_struct_once(**values: Column) -> Column:
    """Several columns generated together, each evaluated once per row."""
    return F.inline(F.array(F.struct(*[value.alias(name) for name, value in values.items()])))


def as_wire_number(number: Column) -> Column:
    """Render a frequency with one decimal and without an exponent."""
    return number.cast("decimal(20,1)").cast("string")
