"""Text expressions whose results follow JavaScript string rules, as plain columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the JavaScript sense: Unicode white space and the byte-order mark.
SPACE = r"[\s\x{FEFF}]"


def trimmed(text: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def squashed(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, rf"(?U){SPACE}+", "")


def is_blank(text: Column) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(trimmed(text) == "", F.lit(True))


def merge_key(text: Column) -> Column:
    """Key under which texts count as equal: lower case, no white space, no CJK punctuation."""
    return F.regexp_replace(squashed(F.lower(F.coalesce(text, F.lit("")))), "[，。、；：！？]", "")


def header_key(text: Column) -> Column:
    """A header for fuzzy comparison: lower case ASCII word characters, CJK, kana and hangul."""
    return F.regexp_replace(F.lower(text), r"[^A-Za-z0-9_\x{4e00}-\x{9fa5}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}]+", "")


def utf16_length(text: Column) -> Column:
    """Number of UTF-16 units."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def utf16_head(text: Column) -> Column:
    """The first UTF-16 unit as a number."""
    return F.conv(F.hex(F.substring(F.encode(text, "UTF-16BE"), 1, 2)), 16, 10).cast("int")


def column_letters(index: Column) -> Column:
    """Spreadsheet letters of a 0-based column number (0 is A, 26 is AA); bijective base 26."""
    step = lambda s, _: F.when(s["n"] <= 0, s).otherwise(
        F.struct(F.floor((s["n"] - 1) / 26).cast("long").alias("n"), F.concat(F.char((65 + (s["n"] - 1) % 26).cast("long")), s["out"]).alias("out"))
    )
    start = F.struct((index + 1).cast("long").alias("n"), F.lit("").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(7)), start, step, lambda s: s["out"])


def column_index(letters: Column) -> Column:
    """The 0-based column number of spreadsheet letters."""
    digit = lambda n, c: (n * 26 + F.ascii(c) - 64).cast("long")
    chars = F.filter(F.split(F.upper(letters), ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), digit) - 1


def safe_file_name(text: Column) -> Column:
    """Path separators and reserved characters replaced by an underscore."""
    return F.regexp_replace(text, r'[/\\:*?"<>|]', "_")


def safe_slice_name(text: Column) -> Column:
    """Anything but word characters, CJK and hyphen replaced by an underscore."""
    return F.regexp_replace(text, r"[^A-Za-z0-9_\x{4e00}-\x{9fa5}-]", "_")


def safe_sheet_name(text: Column) -> Column:
    """A legal worksheet name: trimmed, "sheet" if nothing is left, at most 31 UTF-16 units."""
    clean = trimmed(F.regexp_replace(F.coalesce(text, F.lit("")), r"[:\\/?*\[\]]", "_"))
    named = F.when(clean == "", F.lit("sheet")).otherwise(clean)
    grow = lambda out, c: F.when(utf16_length(F.concat(out, c)) <= 31, F.concat(out, c)).otherwise(out)
    return F.aggregate(F.slice(F.split(named, ""), 1, 31), F.lit(""), grow)


def xml_escaped(text: Column) -> Column:
    """Text for an XML element: control characters dropped, reserved ones escaped."""
    out = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return out


def xml_unescaped(text: Column) -> Column:
    """The named entities of an XML text resolved; the ampersand last."""
    out = text
    for name, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(raw))
    return out


def markdown_cell(text: Column) -> Column:
    """A table cell: line ends as <br>, pipes escaped, trimmed."""
    one_line = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r?\n", "<br>")
    return trimmed(F.replace(one_line, F.lit("|"), F.lit("\\|")))


def markdown_row(cells: Column) -> Column:
    """One Markdown table row of an array of cells."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, markdown_cell), " | "), F.lit(" |"))


def byte_size(n: Column) -> Column:
    """A number of bytes as B, KB or MB with one decimal."""
    kb = F.concat(F.format_string("%.1f", n / F.lit(1024.0)), F.lit(" KB"))
    mb = F.concat(F.format_string("%.1f", n / F.lit(1048576.0)), F.lit(" MB"))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1048576, kb).otherwise(mb)


def js_round(x: Column) -> Column:
    """Rounding half up, also for negative numbers."""
    return F.floor(x + F.lit(0.5))


def cell_text(value: Column) -> Column:
    """Text of a JSON cell value: strings and numbers as they are, an object by its text or value
    member, null as empty."""
    text = F.coalesce(F.get_json_object(value, "$.text"), F.get_json_object(value, "$.value"))
    bare = F.when(value.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")).otherwise(value)
    return F.when(value.isNull() | (value == "null"), F.lit("")).when(value.startswith("{"), F.coalesce(text, value)).otherwise(bare)


def unfenced(text: Column) -> Column:
    """A model's answer without the code fence around it."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)(?i)^```(?:json)?{SPACE}*", ""), rf"(?U){SPACE}*```$", "")


def number_after(text: Column, mark: str) -> Column:
    """The whole number that ends a text after ``mark``; 0 if there is none. Parts of a picture sort by it."""
    found = F.regexp_extract(text, rf"{mark}([0-9]+)$", 1)
    return F.coalesce(F.when(found != "", found.try_cast("long")), F.lit(0))


def day_stamp(moment: Column) -> Column:
    """The day of a moment as YYYY-MM-DD; the clock is the caller's."""
    return F.date_format(moment, "yyyy-MM-dd")


def short_key(parts: Column) -> Column:
    """Sixteen hex digits of the SHA-1 of an array of texts, set apart by NUL."""
    return F.substring(F.sha1(F.array_join(parts, "\u0000").cast("binary")), 1, 16)


def head_lines(lines: Column, most: int = 5) -> Column:
    """The first lines of an array, one a line."""
    return F.array_join(F.slice(lines, 1, most), "\n")
