"""Document metadata read from the page itself."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.text import clean_text
from docpipe.operators import parse


# An href of any tag: in double or single quotes, or bare.
LINK = r"""(?i)<[a-z][^<>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)"""


def _link(value: Column) -> Column:
    quoted = value.rlike("""^["']""")
    return parse.decode_entities(F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add title, summary (the first text element) and links to rows with a page.

    Pages name neither authors nor a date of publication; those stay NULL.
    """
    page = F.col(html)
    title = parse.decode_entities(F.regexp_extract(page, r"(?i)<title\b[^<>]*>([^<]*)", 1))
    first_text = F.get(F.filter(parse.html_elements(page), lambda e: e["type"] == "text"), F.lit(0))
    return pages.select(
        "*",
        F.nullif(clean_text(title), F.lit("")).alias("title"),
        clean_text(first_text["content"]).alias("summary"),
        F.transform(F.regexp_extract_all(page, F.lit(LINK), F.lit(1)), _link).alias("links"),
    )
