"""Column expressions for paths, names, keys and chunk text. No Python UDFs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The white space and word characters that text cleaning is defined on
# (Unicode white space with the four separators 1C-1F; letters, numbers, underscore).
# Breaks are the white space without the newline.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BREAK = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
SPACE_CHARS = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)

# A hyphen at a line end between two word characters, with both characters captured.
# The two possessive runs cannot give back, so long white space costs linear time.
LINE_HYPHEN = rf"([{WORD}])-[{BREAK}]*+\n[{SPACE}]*+([{WORD}])"


def norm_path(path: Column) -> Column:
    """Path without a leading `dbfs:`."""
    return F.regexp_replace(path, "^dbfs:", "")


def safe_name(name: Column) -> Column:
    """File name without single and double quotes."""
    return F.translate(name, "'\"", "")


def chunk_key(doc_path: Column, chunk_id: Column) -> Column:
    return F.concat_ws("_", doc_path, chunk_id)


def join_authors(authors: Column) -> Column:
    """Author list as one text; a NULL list gives the empty text."""
    return F.concat_ws(", ", authors)


def clean_text(text: Column) -> Column:
    """Join words hyphenated at line ends, collapse white space, trim; NULL gives ''."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), LINE_HYPHEN, "$1$2")
    return F.trim(F.regexp_replace(joined, f"[{SPACE}]+", " "))


def strip(text: Column) -> Column:
    """Text without white space at its ends. A pattern would look at inner runs again and again."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def has_text(text: Column) -> Column:
    """True if there is a character that is not white space."""
    return text.rlike(f"[^{SPACE}]")
