"""Text normalisers and document measures as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"


#: every character that WS stands for
BLANKS = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is read."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def normalize_spaces(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{WS}+", " "))


def clean_text(c: Column) -> Column:
    """Unix line ends, tabs to spaces, single spaces, at most one blank line in a row."""
    c = F.regexp_replace(c, r"\r\n?", "\n")
    c = F.regexp_replace(F.replace(c, F.lit("\t"), F.lit(" ")), " {2,}", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize_label(c: Column) -> Column:
    """Lower case, & as ``and``, only a-z 0-9 . / ( ) - kept."""
    c = F.replace(F.lower(c), F.lit("&"), F.lit("and"))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9\s./()-]", " "), r"\s+", " "))


def normalize_header_cell(c: Column) -> Column:
    """A label without bracketed parts and periods."""
    c = F.regexp_replace(normalize_label(c), r"[(\[][^)\]]*[)\]]", " ")
    return F.trim(F.regexp_replace(F.replace(c, F.lit("."), F.lit(" ")), r"\s+", " "))


def contains_label(c: Column, labels: list[str]) -> Column:
    """Whether a normalised text is one of the labels, or starts with one and a space or colon."""
    hit = F.lit(False)
    for label in labels:
        hit = hit | (c == label) | c.startswith(label + " ") | c.startswith(label + ":")
    return hit


def clean_field_value(c: Column, edge: str = " :-|") -> Column:
    return F.btrim(normalize_spaces(c), F.lit(edge))


def normalize_text_value(c: Column, edge: str = " .,:;-|/\\\"'()[]&") -> Column:
    """Single spaces, no punctuation at the ends, upper case."""
    return F.upper(normalize_spaces(F.btrim(normalize_spaces(c), F.lit(edge))))


def collapse_key(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"{WORD}+"))


def line_count(c: Column) -> Column:
    """Lines that hold more than white space."""
    return F.size(F.filter(F.split(F.regexp_replace(c, r"\r\n?|\x0b|\x0c|\x{85}|\x{2028}|\x{2029}", "\n"), "\n"), lambda x: strip(x) != ""))


PAGE_MARKS = (r"(?i)---\s*PAGE\s*\d+\s*---", r"(?i)===\s*PAGE\s*\d+\s*===", r"(?i)\[\s*PAGE\s*\d+\s*\]", r"(?i)PAGE\s+\d+")


def page_count(c: Column) -> Column:
    """Sum of four kinds of page marks (a dashed mark thus counts twice); without marks 1, of blank text 0."""
    marks = sum((F.regexp_count(c, F.lit(p)) for p in PAGE_MARKS[1:]), F.regexp_count(c, F.lit(PAGE_MARKS[0])))
    return F.when(marks > 0, marks).otherwise(F.when(strip(c) != "", 1).otherwise(0))


#: Punctuation that is usual in documents.
USUAL_PUNCTUATION = ".,;:!?+-*/%()[]{}<>_=|&@#$₹€£'\"/\\"


def _share(c: Column, drop: str) -> Column:
    """Share of the characters other than white space that the class ``drop`` leaves; runs are dropped whole, which takes fewer matches."""
    solid = F.length(F.regexp_replace(c, f"{WS}+", ""))
    left = F.length(F.regexp_replace(c, f"[{WS}{drop}]+", ""))
    return F.when(solid > 0, left / solid).otherwise(0.0)


def symbol_ratio(c: Column) -> Column:
    """Share of non-space characters that are neither letters, digits nor usual punctuation."""
    usual = "".join("\\" + x for x in dict.fromkeys(USUAL_PUNCTUATION) if not x.isalnum())
    return _share(c, rf"[\p{{L}}\p{{N}}{usual}]")


def alpha_ratio(c: Column) -> Column:
    return _share(c, r"[^\p{L}]")


def ocr_warning(c: Column) -> Column:
    """Codes joined by ``; ``; EMPTY and VERY_SHORT stand alone."""
    s = strip(c)
    words = word_count(s)
    single = F.regexp_count(s, F.lit(rf"(?<!{WORD})[A-Za-z](?!{WORD})"))
    codes = F.array_compact(
        F.array(
            F.when(symbol_ratio(s) >= 0.35, "HIGH_SYMBOL_RATIO"),
            F.when(alpha_ratio(s) < 0.15, "LOW_ALPHABETIC_RATIO"),
            F.when(s.rlike(r"(.)\1{7,}"), "REPEATED_CHARACTER"),
            F.when((words > 100) & (single / words > 0.25), "HIGH_SINGLE_CHARACTER_RATIO"),
        )
    )
    return F.when(s == "", "EMPTY").when(F.length(s) < 100, "VERY_SHORT").otherwise(F.array_join(codes, "; "))


def suspicious(c: Column) -> Column:
    """Array of codes of a document."""
    s, ocr = strip(c), ocr_warning(c)
    rest = F.array_compact(
        F.array(
            F.when(F.length(s) < 100, "VERY_SHORT"),
            F.when(word_count(c) < 20, "VERY_FEW_WORDS"),
            F.when(F.length(c) > 500_000, "VERY_LARGE"),
            F.when(F.instr(c, "\x00") > 0, "NULL_CHARACTER"),
            F.when(c.rlike(r"\n\s*\n\s*\n\s*\n"), "EXCESSIVE_BLANK_LINES"),
            F.when(ocr != "", F.concat(F.lit("OCR_WARNING:"), ocr)),
        )
    )
    return F.when(s == "", F.array(F.lit("EMPTY_DOCUMENT"))).otherwise(rest)


def document_status(c: Column) -> Column:
    return F.when(strip(c) == "", "EMPTY").when(F.size(suspicious(c)) > 0, "WARNING").otherwise("OK")


def content_key(c: Column) -> Column:
    """md5 of the text with Unix line ends and no white space at its ends."""
    return F.md5(F.replace(strip(c), F.lit("\r\n"), F.lit("\n")))


def tokens(c: Column, stop: list[str] | None = None) -> Column:
    """Upper-case words of three letters or more, hyphens inside allowed, without stop words."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"([A-Za-z][A-Za-z\-]{2,})"), 1), F.upper)
    return F.filter(found, lambda x: ~x.isin(*stop)) if stop else found


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words, joined by spaces; the array is read n times whatever its length."""
    out = words
    for k in range(2, n + 1):
        out = F.zip_with(out, F.slice(words, F.lit(k), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(out, lambda x: x.isNotNull())


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def completion_budget(c: Column) -> Column:
    return F.least(F.greatest(F.floor(F.length(c) / 2).cast("int") + 512, F.lit(1024)), F.lit(4096))


#: Glyphs that open a list entry, three of them from symbol fonts' private area.
BULLETS = ["•", "●", "▪", "", "", ""]


def heading(c: Column, most: int = 15) -> Column:
    """Lines up to the first labelled field, ``with`` clause or bullet; else the first words; at most ``most`` words, then ``...``."""
    lines = F.transform(F.split(c, "\n"), strip)
    stop = lambda x: x.rlike(r"^[A-Za-z][A-Za-z /]{1,30}:\s") | F.lower(x).startswith("with ") | F.substring(x, 1, 1).isin(*BULLETS)
    flags = F.transform(lines, stop)
    first = F.array_position(flags, F.lit(True)).cast("int")
    kept = F.when(first > 0, F.slice(lines, F.lit(1), first - 1)).otherwise(lines)
    words = lambda x: F.filter(F.split(normalize_spaces(x), " "), lambda w: w != "")
    head = words(F.array_join(kept, " "))
    every = words(c)
    short = F.slice(every, 1, most)
    return F.when(F.size(head) == 0, F.array_join(short, " ")).when(F.size(head) > most, F.concat(F.array_join(F.slice(head, 1, most), " "), F.lit("..."))).otherwise(F.array_join(head, " "))


#: Sections that follow an item table, then those that end one wherever they stand.
AFTER_TABLE = [
    "notes and clarifications", "notes clarifications", "exclusions", "clarifications and deviations",
    "scope definition", "scope defin", "commercial conditions", "terms and conditions", "scope of supply", "technical specifications", "warranty", "payment terms", "delivery terms",
]
#: Labels of total rows.
TOTAL_LABELS = ["total", "grand total", "net total", "total amount", "final total", "total payable", "net amount", "amount payable", "subtotal", "sub total", "sub-total", "total before tax"]


def is_total_label(c: Column) -> Column:
    return normalize_label(c).isin(*TOTAL_LABELS)


def is_after_table_heading(c: Column) -> Column:
    """Whether a line of at most eight words is such a section's heading, with or without its number."""
    bare = F.regexp_replace(normalize_label(c), r"^(?:section|part)[\s-]*\d*\s*[-:.]?\s*", "")
    bare = F.regexp_replace(bare, r"[^a-z ]", " ")
    bare = normalize_spaces(bare)
    hit = F.lit(False)
    for phrase in AFTER_TABLE:
        hit = hit | (bare == phrase) | bare.startswith(phrase + " ")
    return hit & (F.size(F.split(normalize_label(c), " ")) <= 8)
