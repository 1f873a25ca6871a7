"""CSV tokenising and field cleaning as Spark column expressions.

The reference splits each raw line with Python's ``csv.reader`` (default
dialect: ``,`` delimiter, ``"`` quote, doubled quotes, no initial-space
skipping, non-strict) and cleans a field with ``.strip().strip('"')``.  These
expressions reproduce both with JVM-side string functions, so parsing stays in
whole-stage codegen and no row crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reader's behaviour):
# one field is either a quoted run -- opening quote, any mix of non-quote
# characters and doubled quotes, then a closing quote followed by literal
# characters up to the next comma, or the end of the line -- or a plain run of
# non-comma characters.  The leading comma added to every line anchors each match
# on a separator so a zero-length first field cannot swallow the next comma.
# ``\z`` and DOTALL: Java's ``$`` and ``.`` treat U+0085, U+2028 and U+2029 as
# line ends, the reader treats them as ordinary characters.
FIELD_PATTERN = r',("(?:[^"]++|"")*+(?:"[^,]*|\z)|[^,]*)'
# A quoted token: body with doubled quotes, optional closing quote, literal tail.
QUOTED_PATTERN = r'(?s)^"((?:[^"]++|"")*+)"?(.*)\z'


# The characters Python's ``str.strip()`` removes; all of them are below U+3001.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def tokenize(line: Column) -> Column:
    """``ARRAY<STRING>`` of raw (still quoted) CSV tokens of one line."""
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD_PATTERN), 1)


# Fixed value: stands in for the 3-character separator '","' so that the compact
# split uses the single-character (non-regex) fast path.  A line that already
# contains it takes the exact path.
_SEP = "\u0001"

# Kinds of the value arrays produced by :func:`split_fields`.
VALUES, FIRST_RAW, ALL_RAW = 0, 1, 2


def _count(line: Column, what: str) -> Column:
    """Occurrences of an ASCII substring (byte-length difference after removing it)."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(what), F.lit("")))) / F.lit(len(what))


def between_quotes(line: Column) -> Column:
    """A line without its outer quotes and with ``","`` as one character (see :func:`split_fields`)."""
    return F.replace(F.substring(line, 2, F.length(line) - 2), F.lit('","'), F.lit(_SEP))


def split_fields(line: Column, pieces: Column | None = None) -> Column:
    """``STRUCT<kind INT, v ARRAY<STRING>>``: the line's fields, as the reader splits them.

    Two shapes cover real files and split without a regular expression:

    * compact -- every field quoted once, ``"a","b, c","d"``: if the line starts
      and ends with a quote and no quote is left between the separators ``","``,
      the fields are the pieces between them and already unquoted (``kind`` 0);
    * padded -- ``"a", "b", "c"``: with no ``,"`` in the line no field but the
      first opens a quote, so a plain comma split gives the raw tokens; only the
      first may still need unquoting (``kind`` 1).

    Any other line is tokenised by :func:`tokenize` (``kind`` 2: all raw).  ``pieces`` is the line's
    :func:`between_quotes`, which is read twice; pass it where it is a column already.
    """
    pieces = between_quotes(line) if pieces is None else pieces
    quoted_ends = line.startswith('"') & line.endswith('"') & (F.octet_length(line) >= 2)
    compact = quoted_ends & ~line.contains(_SEP) & ~pieces.contains('"')
    first = F.substring_index(line, ",", 1)
    first_simple = ~first.startswith('"') | (first.endswith('"') & (F.length(first) >= 2) & (_count(first, '"') == 2))
    padded = ~line.contains(',"') & first_simple
    return (F.when(compact, F.struct(F.lit(VALUES).alias("kind"),
                                     F.split(pieces, _SEP, -1).alias("v")))
            .when(padded, F.struct(F.lit(FIRST_RAW).alias("kind"), F.split(line, ",", -1).alias("v")))
            .otherwise(F.struct(F.lit(ALL_RAW).alias("kind"), tokenize(line).alias("v"))))


def unquote(token: Column) -> Column:
    """Field value of one raw token, exactly as the CSV reader yields it."""
    body = F.regexp_extract(token, QUOTED_PATTERN, 1)
    tail = F.regexp_extract(token, QUOTED_PATTERN, 2)
    return F.when(token.startswith('"'), F.concat(F.replace(body, F.lit('""'), F.lit('"')), tail)).otherwise(token)


def py_strip(value: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.btrim(value, F.lit(PY_WHITESPACE))


def strip_quotes(value: Column) -> Column:
    """Python ``str.strip('"')``: remove every leading and trailing quote."""
    return F.btrim(value, F.lit('"'))


def csv_value(token: Column) -> Column:
    """The reader's value of a raw token.

    Unquoted tokens are their own value; a token quoted once around its whole
    text loses the two quotes (plain ``substring``); anything else -- doubled or
    stray quotes, an unterminated quote -- takes the exact regex path.
    """
    n = F.length(token)
    simple_quoted = token.startswith('"') & (F.locate('"', token, 2) == n)
    return (F.when(~token.startswith('"'), token)
            .when(simple_quoted, F.substring(token, 2, n - 2))
            .otherwise(unquote(token)))


def clean_field(token: Column) -> Column:
    """The reference's ``field.strip().strip('"')`` of a raw token."""
    return strip_quotes(py_strip(csv_value(token)))


def number_text(token: Column) -> Column:
    """``field.strip().strip('"').strip()``: the text ``float()`` finally reads."""
    return py_strip(clean_field(token))
