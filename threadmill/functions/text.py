"""Column functions on text. All stay inside the JVM."""

from __future__ import annotations

import json
import string
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.functions import patterns as P

#: White space beyond ASCII, and the separators that count as white space in Unicode.
SPACES = r"[\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Letters, and digits, beyond ASCII.
LETTERS = r"[^\x00-\x7F\P{L}]|[^\x00-\x7F\P{N}]"


def fold(text: Column) -> Column:
    """Every letter and digit beyond ASCII as '_', marks as '·', white space of all kinds as ' '; the length stays the same."""
    folded = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, SPACES, " "), LETTERS, "_"), r"\p{M}", "·")
    return F.when(text.rlike(r"[^\x00-\x0a\x0c-\x1b\x20-\x7F]"), folded).otherwise(text)


def has(folded: Column, pattern: str) -> Column:
    return folded.rlike(f"(?id){pattern}")


def count(folded: Column, pattern: str) -> Column:
    return F.regexp_count(folded, F.lit(f"(?id){pattern}"))


def words(folded: Column) -> Column:
    return count(folded, P.WORD)


def prose(text: Column) -> Column:
    """The text with fenced code replaced by one space."""
    return F.regexp_replace(text, P.CODE_FENCE, " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def rounded(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator to so many digits, halves to even; 0 where the denominator is 0."""
    scale = 10.0**digits
    return F.when(denominator == 0, F.lit(0.0)).otherwise(F.rint(numerator * F.lit(scale) / F.greatest(denominator, F.lit(1))) / F.lit(scale))


@cache
def compatibility() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose compatibility form has letters or digits of ASCII: one to one, and one to several. From the Unicode tables."""
    one, several = {}, []
    for i in [*range(0x80, 0xD800), *range(0xE000, 0x20000)]:
        form = unicodedata.normalize("NFKC", chr(i))
        if form != chr(i) and any(c.isascii() and c.isalnum() for c in form.lower()):
            if len(form) == 1:
                one[chr(i)] = form
            else:
                several.append((chr(i), form))
    return "".join(one), "".join(one.values()), tuple(several)


@cache
def composed() -> str:
    """A pattern for ASCII letters with a mark that make one character of their own beyond ASCII. From the Unicode tables."""
    by: dict[str, str] = {}
    for i in range(0x300, 0x370):
        letters = "".join(c for c in string.ascii_letters if len(unicodedata.normalize("NFC", c + chr(i))) == 1)
        if letters:
            by[letters] = by.get(letters, "") + chr(i)
    return "|".join(f"[{letters}][{marks}]" for letters, marks in by.items())


def ranges(chars: str, gap: int = 32) -> str:
    """A character class of few ranges that covers these characters, and what lies in gaps of up to ``gap`` between them."""
    spans: list[list[int]] = []
    for i in sorted(map(ord, set(chars))):
        if spans and i - spans[-1][1] <= gap:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


def nfkc(text: Column) -> Column:
    """The text in compatibility form, as far as letters and digits of ASCII go; what composes to others becomes a blank.

    No built-in function normalises; the tables are small and the expression stays
    in the JVM. Texts without any character of the tables' ranges pass untouched.
    """
    source, target, several = compatibility()
    # one literal instead of hundreds of expressions; folded to a constant by the optimizer
    forms = F.from_json(F.lit(json.dumps([{"c": c, "f": f} for c, f in several])), "array<struct<c: string, f: string>>")
    marks = r"[\x{300}-\x{36F}]"
    unfolded = F.when(text.rlike(ranges("".join(c for c, _ in several))), F.aggregate(forms, text, lambda t, m: F.replace(t, m["c"], m["f"]))).otherwise(text)
    flat = F.translate(unfolded, source, target)
    flat = F.when(text.rlike(marks), F.regexp_replace(flat, composed(), " ")).otherwise(flat)
    return F.when(text.rlike(f"{marks}|{ranges(source + ''.join(c for c, _ in several))}"), flat).otherwise(text)


def norm(text: Column) -> Column:
    """Lower case, compatibility forms unfolded, only [a-z0-9] runs apart by single blanks. Text that is ASCII never leaves the JVM."""
    return norm_ascii(nfkc(text))


def norm_ascii(text: Column) -> Column:
    """``norm`` of text that is in normal form already, for use on array elements."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def tokens(normed: Column) -> Column:
    return F.filter(F.split(normed, " "), lambda w: w != "")


def grams(toks: Column, n: int) -> Column:
    """Hashes of all runs of n tokens, by start."""
    starts = F.when(F.size(toks) >= n, F.sequence(F.lit(1), F.size(toks) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(toks, i, F.lit(n)), " ")))


def covered(hits: Column, n: int) -> Column:
    """Number of places covered by runs of n that begin at these ascending places."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(-(1 << 30)).alias("end"))
    return F.aggregate(hits, start, lambda a, x: F.struct((a["sum"] + x + n - F.greatest(a["end"], x)).alias("sum"), (x + n).alias("end")))["sum"]


def voice_score(folded: Column, n: Column) -> Column:
    """Twice the rate of first-person words plus the rate of spoken fillers, each per 100 words."""
    per = F.greatest(n, F.lit(1))
    return 2 * (count(folded, P.FIRST_PERSON) * 100.0 / per) + count(folded, P.SPOKEN_FILLER) * 100.0 / per


def slug(title: Column, n: int = 60) -> Column:
    low = F.lower(F.coalesce(F.nullif(title, F.lit("")), F.lit("untitled")))
    kept = strip(F.regexp_replace(low, r"[^\p{L}\p{N}_\s-]", ""))
    return F.coalesce(F.nullif(F.regexp_replace(F.substring(F.regexp_replace(kept, r"[\s_]+", "-"), 1, n), "-+$", ""), F.lit("")), F.lit("untitled"))


def link(stem: Column, title: Column, prefix: str = "", style: str = "wikilink") -> Column:
    """A link to a transcript as it stands in a table: bars of the title are escaped."""
    shown = F.replace(title, F.lit("|"), F.lit("\\|"))
    if style == "markdown":
        return F.format_string("[%s](%s%s.md)", shown, F.lit(prefix), stem)
    return F.format_string("[[%s\\|%s]]", stem, shown)


def day(seconds: Column) -> Column:
    """The calendar day of an epoch time in the session's time zone; null where the time is missing or 0."""
    return F.date_format(F.timestamp_seconds(F.nullif(seconds, F.lit(0.0))), "yyyy-MM-dd")


def part_text(part: str | None) -> str:
    """A plain string as it is; of a JSON object its text field, '' without one; '' for null."""
    if not part:
        return ""
    if part.lstrip()[:1] == "{":
        try:
            value = json.loads(part)
        except (ValueError, RecursionError):
            return part
        if isinstance(value, dict):
            text = value.get("text")
            return text if isinstance(text, str) else ""
    return part


def part_text_column(part: Column) -> Column:
    """The same inside the JVM."""
    value = F.try_parse_json(part)
    as_object = F.coalesce(F.try_variant_get(value, "$.text", "string"), F.lit(""))
    return F.when(part.rlike(r"\A\s*\{") & value.isNotNull(), as_object).otherwise(F.coalesce(part, F.lit("")))


def message_text(parts: Column) -> Column:
    """The non-empty part texts joined by line breaks, stripped."""
    return strip(F.array_join(F.filter(F.transform(parts, part_text_column), lambda t: t != ""), "\n"))
