"""HTML documents to JSON of typed elements, with native expressions only."""

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.text import SPACE, norm_path, strip
from docpipe.operators import registry, tables

# What a reader does not see as content. No pattern may look twice for an end that is not
# there: a page of open tags would cost the square of its length.

# Comments and machine text. Without an end they run to the end of the page, as in browsers.
HIDDEN = (
    r"(?s)<!--.*?(?:-->|\z)",
    r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)",
)

# Navigation, head and ads, removed if they end; else the rest of the page is put back.
ASIDE = (
    r"(?is)<nav\b.*?</nav\s*>|(<nav\b.*)",
    r"(?is)<footer\b.*?</footer\s*>|(<footer\b.*)",
    r"(?is)<head\b.*?</head\s*>|(<head\b.*)",
    r"(?is)<title\b.*?</title\s*>|(<title\b.*)",
    r'(?is)<div class="ad">.*?</div>|(<div class="ad">.*)',
)

# Named character references that are found without a look at the whole table.
COMMON_NAMES = ("amp", "lt", "gt", "quot", "nbsp", "apos")

# Tags that end an element and start a new one. Text outside of any is an element too; noise is
# what HIDDEN and ASIDE take away.
BLOCKS = (
    "p|div|section|article|main|body|html|header|aside|ul|ol|li|dl|dt|dd|table|caption|thead|tbody"
    "|tfoot|tr|td|th|pre|blockquote|figure|figcaption|form|fieldset|legend|address|details|summary|hr"
)

# Starts a piece of the page; the letter behind it says which kind.
MARK = "\x02"


def html_text(content: Column) -> Column:
    """File bytes as text. Bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def _character(code: Column) -> Column:
    """The character with that number; U+FFFD if there is none."""
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Text with character references, named or by number, as characters. Unknown ones stay."""
    # one literal, which Spark reads once for a query
    names = json.dumps({name[:-1]: char for name, char in html5.items() if name[-1] == ";"})
    table = F.from_json(F.lit(names), "map<string,string>")

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        char = F.when(name == "", None)
        for common in COMMON_NAMES:
            char = char.when(name == common, F.lit(html5[f"{common};"]))
        char = char.when(name.rlike("^#[xX]"), _character(F.conv(F.substr(name, F.lit(3)), 16, 10).cast("int")))
        char = char.when(name.startswith("#"), _character(F.substr(name, F.lit(2)).cast("int")))
        char = char.otherwise(F.try_element_at(table, name))
        rest = F.substr(piece, F.length(name) + 2)
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    tail = F.transform(F.slice(pieces, 2, F.size(pieces)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(pieces[0], F.array_join(tail, ""))).otherwise(text)


def html_elements(html: Column) -> Column:
    """Page → array of (id, type, content), in page order.

    `title` comes from h1, `heading` from h2 to h6, `text` from all else that is seen: paragraphs,
    list items, table cells, preformatted text and what stands in no block at all. Machine text,
    comments, navigation, page footers, the head and ads are noise. An element ends where the next
    block starts or one closes, so open tags do no harm.
    """
    page = F.translate(html, MARK, "")
    for pattern in HIDDEN:
        page = F.regexp_replace(page, pattern, "")
    for pattern in ASIDE:
        page = F.regexp_replace(page, pattern, "$1")
    page = F.regexp_replace(page, r"(?i)<h1\b[^<>]*>", MARK + "h")
    page = F.regexp_replace(page, r"(?i)<h[2-6]\b[^<>]*>", MARK + "s")
    page = F.regexp_replace(page, rf"(?i)(?:</?(?:{BLOCKS})\b[^<>]*>|</h[1-6]\s*>)", MARK + "p")
    page = F.regexp_replace(page, r"(?i)<br\s*/?>", "\n")
    page = F.regexp_replace(page, r"<[^<>]*>", "")
    page = F.concat(F.lit("p"), page)
    pieces = F.filter(F.split(page, MARK), lambda p: p.rlike(f"^[hsp][{SPACE}]*[^{SPACE}]"))
    return F.transform(
        pieces,
        lambda p, i: F.struct(
            i.cast("string").alias("id"),
            F.when(p.startswith("h"), "title")
            .when(p.startswith("s"), "heading")
            .otherwise("text")
            .alias("type"),
            decode_entities(strip(F.substr(p, F.lit(2)))).alias("content"),
        ),
    )


def to_json(elements: Column) -> Column:
    """Elements → the JSON text kept in `parsed_content`."""
    return F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document")))


def to_parsed_docs(files: DataFrame) -> DataFrame:
    """Files (path, content) → rows of the parsed table; paths are the registry's."""
    return files.select(
        norm_path(F.col("path")).alias("path"),
        to_json(html_elements(html_text(F.col("content")))).alias("parsed_content"),
        F.current_timestamp().alias("processed"),
    )


def to_markdown(elements: Column) -> Column:
    """Elements → one text, titles and headings marked."""
    return F.array_join(
        F.transform(
            elements,
            lambda e: F.when(e["type"] == "title", F.concat(F.lit("# "), e["content"]))
            .when(e["type"] == "heading", F.concat(F.lit("## "), e["content"]))
            .otherwise(e["content"]),
        ),
        "\n\n",
    )


def append_parsed(parsed: DataFrame, table: str) -> None:
    """Append the documents that the table does not hold, one row for each path.

    So a rerun adds nothing. Of rows with one path the latest stays. Paths are written without
    `dbfs:`, as the registry's are.
    """
    doc_path = norm_path(F.col("path")).alias("doc_path")
    held = parsed.sparkSession.table(table).select(norm_path(F.col("path")))
    latest = F.max(F.struct("processed", "path", "parsed_content")).alias("r")
    one = parsed.where(F.col("path").isNotNull()).groupBy(doc_path).agg(latest).select("doc_path", "r.*")
    new = registry.without(one, F.col("doc_path"), held)
    tables.append(new.withColumn("path", F.col("doc_path")), table)
