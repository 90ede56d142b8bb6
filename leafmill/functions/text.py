"""Column functions on text: JavaScript string semantics, normalisation, tokens, sentences,
HTML, figure references. Each takes and returns Columns; null counts as empty unless said."""

from __future__ import annotations

import html as _html
import re
import unicodedata
from html.entities import html5 as _NAMED

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as JavaScript's \s and trim() know it.
JS_WS = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"

# They must equal the reference's for right results.
PROTECTED = ("Fig.", "Dr.", "Mr.", "Mrs.", "Ms.", "Prof.", "Sr.", "Jr.", "No.", "Vol.", "vs.", "etc.", "i.e.", "e.g.", "et al.", "cf.", "ca.", "approx.")
COMPOUNDS = ("deep-seated", "well-known", "long-term", "short-term", "high-grade", "low-grade", "pre-operative", "post-operative", "intra-operative", "extra-axial", "intra-axial", "venous-arterial", "arterio-venous")
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st"}
QUOTES = {"\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"', "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u00ab": '"', "\u00bb": '"', "\u2039": "'", "\u203a": "'"}
DASHES = {"\u2013": "-", "\u2014": "--", "\u2012": "-", "\u2015": "--"}


#: The characters of JS_WS.
WS_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def js_trim(x: Column) -> Column:
    return F.btrim(x, F.lit(WS_CHARS))


def utf16_length(x: Column) -> Column:
    return F.length(x) + F.regexp_count(x, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def tokens(x: Column) -> Column:
    """A quarter of the UTF-16 units, rounded up."""
    return F.coalesce(F.ceil(utf16_length(x) / 4), F.lit(0)).cast("long")


@F.pandas_udf(StringType())
def _nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _unescape(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else _html.unescape(t))


#: A character reference up to its semicolon.
_CLOSED = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+)|[0-9A-Za-z]+);")


@F.pandas_udf(StringType())
def _unescape_closed(x: pd.Series) -> pd.Series:
    one = lambda m: _html.unescape(m[0]) if m[0][1] == "#" else _NAMED.get(m[0][1:], m[0])
    return x.map(lambda t: None if t is None else _CLOSED.sub(one, t))


#: Beyond these ranges a character may compose, decompose or be one of a pair (in them, none does).
_MAY_COMPOSE = r"[^\x00-\u024F\u0400-\u0482\u2002-\u205E\uFB00-\uFB06]"


def nfc(x: Column) -> Column:
    """Only text with characters that may compose crosses into Python."""
    may = x.rlike(_MAY_COMPOSE)
    return F.coalesce(F.when(may, _nfc(F.when(may, x))).otherwise(x), F.lit(""))


def is_decomposed(x: Column) -> Column:
    """Whether a combining mark of U+0300 to U+036F stands in the text."""
    return F.coalesce(x.rlike(r"[\u0300-\u036F]"), F.lit(False))


def combining_marks(x: Column) -> Column:
    return F.regexp_count(x, F.lit(r"[\u0300-\u036F\u1AB0-\u1AFF\u1DC0-\u1DFF\u20D0-\u20FF\uFE20-\uFE2F]"))


def line_breaks(x: Column) -> Column:
    return F.regexp_replace(x, "\r\n?", "\n")


def rejoin_hyphenated(x: Column) -> Column:
    """word-\\nword: known compounds keep the hyphen, as do two valid words too long for one;
    all else is joined. Breaks are marked in one pass, so matches never overlap."""
    # possessive, and from a word's begin alone, so a run of letters is read once
    marked = F.regexp_replace(x, r"(?<!\w)(\w++)-\r?\n(\w++)", "\ufdd0$1\ufdd1$2\ufdd2")
    compounds = "|".join(c.replace("-", "\ufdd1") for c in COMPOUNDS)
    kept = F.regexp_replace(marked, f"(?i)\ufdd0({compounds})\ufdd2", "\ufdd3$1\ufdd2")
    kept = F.regexp_replace(kept, "\ufdd3(\\w+)\ufdd1(\\w+)\ufdd2", "$1-$2")
    half = "(?=[A-Za-z]{0,29}[aeiouAEIOU])[A-Za-z]{3,30}"
    kept = F.regexp_replace(kept, f"\ufdd0(?=[^\ufdd2]{{32,}}\ufdd2)({half})\ufdd1({half})\ufdd2", "$1-$2")
    joined = F.regexp_replace(F.regexp_replace(kept, "[\ufdd0\ufdd2]", ""), "\ufdd1", "")
    return F.when(x.contains("-\n") | x.contains("-\r\n"), joined).otherwise(x)


def ligatures(x: Column) -> Column:
    out = x
    for mark, plain in LIGATURES.items():
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return F.when(x.rlike("[\ufb00-\ufb06]"), out).otherwise(x)


def ligature_count(x: Column) -> Column:
    return F.coalesce(F.regexp_count(x, F.lit("[\ufb00-\ufb06]")), F.lit(0)).cast("long")


def punctuation(x: Column) -> Column:
    quotes = F.translate(x, "".join(QUOTES), "".join(QUOTES.values()))
    one = [k for k, v in DASHES.items() if v == "-"]
    out = F.regexp_replace(F.translate(quotes, "".join(one), "-" * len(one)), "[\u2014\u2015]", "--")
    return F.when(x.rlike("[" + "".join([*QUOTES, *DASHES]) + "]"), out).otherwise(x)


def remove_controls(x: Column) -> Column:
    return F.regexp_replace(x, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\u200B-\u200D\uFEFF\u00AD]", "")


def whitespace(x: Column) -> Column:
    """Blanks and tabs collapse; line breaks stay."""
    return js_trim(F.regexp_replace(remove_controls(line_breaks(x)), "\t[ \t]*+| [ \t]++", " "))


def normalize(x: Column) -> Column:
    x = F.coalesce(x, F.lit(""))
    return whitespace(punctuation(ligatures(rejoin_hyphenated(line_breaks(nfc(x))))))


def normalized(x: Column) -> Column:
    """text, and the ligatures before and after, as a struct."""
    text = normalize(x)
    return F.struct(text.alias("text"), ligature_count(x).alias("ligatures_before"), ligature_count(text).alias("ligatures_after"))


def strip_html(x: Column, strict: bool = False) -> Column:
    """Text without tags, entities decoded, also those without a semicolon; strict: only those that end in one."""
    bare = F.regexp_replace(F.coalesce(x, F.lit("")), "<[^>]+>", "")
    unescape = _unescape_closed if strict else _unescape
    decoded = F.when(bare.contains("&"), unescape(F.when(bare.contains("&"), bare))).otherwise(bare)
    return js_trim(F.replace(decoded, F.lit("\u00a0"), F.lit(" ")))


def heading_level(x: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(x, "(?i)<h([1-6])[^>]*>", 1), F.lit("")).cast("int"), F.lit(0))


def sentences(x: Column) -> Column:
    """Sentences of a text; abbreviations and decimals don't end one. Abbreviations are found in any
    case and inside words, and come back in their canonical case."""
    marked = x
    for i, abbreviation in enumerate(PROTECTED):
        marked = F.regexp_replace(marked, rf"(?i)\Q{abbreviation}\E", f"\ufdd4{chr(0xFDD8 + i)}")
    x = F.when(x.rlike("(?i)" + "|".join(rf"\Q{a}\E" for a in PROTECTED)), marked).otherwise(x)
    x = F.regexp_replace(x, r"(?<!\d)(\d++)\.(\d++)", "$1\ufdd5$2")
    parts = F.split(F.regexp_replace(x, rf"([.!?]){JS_WS}+(?=[A-Z])", "$1\ufdd6"), "\ufdd6", -1)

    def restore(s: Column) -> Column:
        out = s
        for i, abbreviation in enumerate(PROTECTED):
            out = F.replace(out, F.lit(f"\ufdd4{chr(0xFDD8 + i)}"), F.lit(abbreviation))
        return F.replace(F.when(s.contains("\ufdd4"), out).otherwise(s), F.lit("\ufdd5"), F.lit("."))

    return F.coalesce(F.transform(F.filter(F.transform(parts, js_trim), lambda s: s != ""), restore), F.array().cast("array<string>"))


def last_sentences(x: Column, n: int = 2) -> Column:
    all_ = sentences(x)
    return F.slice(all_, F.greatest(F.lit(1), F.size(all_) - (n - 1)), F.lit(n))


def figure_id(x: Column) -> Column:
    number = F.regexp_extract(x, r"(?i)(?:FIGURE|Fig\.)\s*(\d+\.\d+)", 1)
    return F.when(number != "", F.concat(F.lit("Fig. "), number))


def inline_image(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"!\[[^\]]*\]\(([^)]+)\)", 1), F.lit(""))


def caption_text(x: Column) -> Column:
    """Without its first image and the first figure label at a line start."""
    first = lambda pattern, y: F.regexp_replace(y, rf"(?s)\A(.*?)(?:{pattern})", "$1")
    bare = first(r"!\[[^\]]*\]\([^)]+\)", x)
    return js_trim(first(r"(?m:^)(?i:FIGURE|Fig\.)\s*\d+\.\d+\.?\s*", bare))


def expand_range(start: Column, end: Column) -> Column:
    """'4.1', '4.3' or '3' to the labels between; another chapter or no number gives the start alone."""
    chapter, a = F.regexp_extract(start, r"^(\d+)\.(\d+)$", 1), F.regexp_extract(start, r"^(\d+)\.(\d+)$", 2)
    full = end.rlike(r"^\d+\.\d+$")
    b = F.when(full, F.regexp_extract(end, r"^(\d+)\.(\d+)$", 2)).when(end.rlike(r"^\d+$"), end)
    same = F.when(full, F.substring_index(end, ".", 1) == chapter).otherwise(F.lit(True))
    lo, hi = F.nullif(a, F.lit("")).cast("int"), b.cast("int")
    labels = F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda i: F.concat(F.lit("Fig. "), chapter, F.lit("."), i.cast("string")))
    return F.when(hi.isNull() | ~same | lo.isNull(), F.array(F.concat(F.lit("Fig. "), start))).when(hi < lo, F.array().cast("array<string>")).otherwise(labels)


def figure_references(x: Column) -> Column:
    """Labels of single, range and list references, distinct, sorted by code unit."""
    label = lambda y: F.transform(y, lambda n: F.concat(F.lit("Fig. "), n))
    single = label(F.regexp_extract_all(x, F.lit(r"(?i)Fig\.\s*(\d+\.\d+)"), F.lit(1)))
    ranges = F.lit(r"(?i)Figs\.\s*(\d+\.\d+)\s*[-\u2013]\s*(\d+\.?\d*)(?:\s+and\s+(\d+\.\d+))?")
    start, end, extra = (F.regexp_extract_all(x, ranges, F.lit(i)) for i in (1, 2, 3))
    spans = F.flatten(F.zip_with(start, end, expand_range))
    listed = F.flatten(F.transform(F.regexp_extract_all(x, F.lit(r"(?i)Figs\.\s*([\d.,\s]+(?:and\s+\d+\.\d+)?)"), F.lit(1)), lambda g: F.regexp_extract_all(g, F.lit(r"\d+\.\d+"), F.lit(0))))
    every = F.concat(single, spans, label(F.filter(extra, lambda e: e != "")), label(listed))
    return F.array_sort(F.array_distinct(every))


def parsed_references(x: Column) -> Column:
    """Labels as the JSON parser finds them: single references, then the starts of ranges, in the order of first mention."""
    found = [F.regexp_extract_all(x, F.lit(p), F.lit(1)) for p in (r"(?i)Fig\.\s*(\d+\.\d+)", r"(?i)Figs\.\s*(\d+\.\d+)\s*[-\u2013]\s*\d+\.?\d*")]
    return F.array_distinct(F.transform(F.concat(*found), lambda n: F.concat(F.lit("Fig. "), n)))


def snippet(x: Column, limit: int = 100) -> Column:
    """At most limit UTF-16 units, cut at the last blank within them, and '...'."""
    beyond = x.rlike(r"[\x{10000}-\x{10FFFF}]")
    # a character beyond the basic plane counts twice
    fits = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(limit)), lambda n: utf16_length(F.substring(x, F.lit(1), n)) <= limit))
    head = F.when(beyond, F.substring(x, F.lit(1), fits)).otherwise(F.substring(x, 1, limit))
    cut = F.when(head.contains(" "), F.regexp_replace(head, r"(?s)\A(.*) .*\z", "$1")).otherwise(head)
    return F.when(utf16_length(x) <= limit, x).otherwise(F.concat(cut, F.lit("...")))


def is_abbreviation_line(x: Column) -> Column:
    """A line with an entry 'A., artery;', or one that ends with an entry."""
    entry = rf"[A-Z][a-z]*+\.,{JS_WS}*+[a-z]++(?:{JS_WS}++[a-z]++)*+"
    return x.rlike(f"{entry};") | js_trim(x).rlike(rf"{entry}\.?\z")


def abbreviation_block(x: Column) -> Column:
    """The abbreviation lines at the end of a caption, blank lines left out; null if there are none."""
    lines = F.filter(F.transform(F.split(x, "\n", -1), js_trim), lambda line: line != "")
    other = F.array_max(F.filter(F.transform(lines, lambda line, i: F.when(~is_abbreviation_line(line), i + 1)), lambda i: i.isNotNull()))
    tail = F.slice(lines, F.coalesce(other, F.lit(0)) + 1, F.size(lines))
    return F.nullif(F.array_join(tail, "\n"), F.lit(""))


def caption_abbreviations(x: Column) -> Column:
    """The map of the caption's abbreviation block; empty without one."""
    return abbreviations(F.coalesce(abbreviation_block(x), F.lit("")))


def abbreviations(x: Column) -> Column:
    """'A., artery; V., vein' as a map; the last value of a key wins."""
    pattern = r"([A-Z][a-z]*\.),\s*([^;.]+)"
    keys, values = F.regexp_extract_all(x, F.lit(pattern), F.lit(1)), F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(2)), js_trim)
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))), lambda p: ~F.exists(F.slice(keys, p["i"] + 2, F.greatest(F.size(keys), F.lit(1))), lambda k: k == p["k"]))
    return F.map_from_arrays(F.transform(last, lambda p: p["k"]), F.transform(last, lambda p: p["v"]))
