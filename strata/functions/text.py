"""Text column functions for feed items.

Everything runs in the JVM.  Java's ``\\s`` is ASCII only, so the patterns use ``(?U)`` (Unicode
classes) plus the four information separators that Python's ``str.isspace`` also treats as blank.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[\s\x{1c}-\x{1f}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_id(c) -> Column:
    """md5 hex of the URL text."""
    return F.md5(_c(c).cast("string"))


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), r"<[^>]+>", " ")


def normalize_spaces(c) -> Column:
    """Collapse blank runs, drop the blank before ``.,!?;:``, strip both ends."""
    x = F.regexp_replace(_c(c), rf"(?U){_WS}+", " ")
    x = F.regexp_replace(x, r" ([.,!?;:])", "$1")
    return F.trim(x)


def _table(pairs: dict[str, str]) -> Column:
    """A fixed mapping as one literal map (folded once, however many entries)."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in pairs.items())), F.lit("\x01"), F.lit("\x02"))


# The names come from the standard library's table of the HTML standard.  A name ends with ";", but for
# the old ones, which also count without it and as the beginning of a longer word.
_NAMED = {name: text for name, text in html5.items() if name.endswith(";")}
_OLD = {name: text for name, text in html5.items() if not name.endswith(";")}
_OLD_PATTERN = "^(" + "|".join(sorted(_OLD, key=lambda name: (-len(name), name))) + ")"
# FIXED VALUES: numbers 128 to 159 stand for the characters of windows-1252
_WINDOWS = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}


def _character(number: Column) -> Column:
    """The text of a numeric reference: none for control and non-characters, U+FFFD for what is no character."""
    wrong = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    silent = (number.between(1, 8) | number.between(14, 31) | (number == 11) | (number == 127)
              | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE))
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (F.when(wrong, "\ufffd").when(number.between(128, 159), F.try_element_at(_table(_WINDOWS), number.cast("string")))
            .when(silent, "").otherwise(plain))


def _after_ampersand(p: Column) -> Column:
    """What stands for ``&`` and the text up to the next one."""
    number = F.regexp_extract(p, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    name = F.regexp_extract(p, r"^[^\t\n\f <&#;]{1,32};", 0)
    found = F.array(F.struct(number.alias("number"), name.alias("name"), F.try_element_at(_table(_NAMED), name).alias("text"),
                             F.regexp_extract(p, _OLD_PATTERN, 1).alias("old")))

    def after(part: Column) -> Column:
        return F.substr(p, F.length(part) + 1)

    def value(text: Column) -> Column:
        digits = F.ltrim(F.regexp_replace(text, r"^#[xX]?|;$", ""), F.lit("0"))
        base = F.when(text.rlike("^#[xX]"), 16).otherwise(10)
        # longer than any code point: out of range, whatever the digits
        return F.when(F.length(digits) > 9, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(
            F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint"))
    return F.transform(found, lambda f: (
        F.when(f["number"] != "", F.concat(_character(value(f["number"])), after(f["number"])))
        .when(f["text"].isNotNull(), F.concat(f["text"], after(f["name"])))
        .when(f["old"] != "", F.concat(F.try_element_at(_table(_OLD), f["old"]), after(f["old"])))
        .otherwise(F.concat(F.lit("&"), p))))[0]


def decode_entities(c) -> Column:
    """HTML entities, named and numeric, to their text in one pass: the text is cut at ``&`` and each piece is
    read from fixed tables."""
    x = _c(c)
    pieces = F.split(x, "&")
    first, rest = F.get(pieces, 0), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.when(~x.contains("&"), x).otherwise(
        F.concat(first, F.array_join(F.transform(rest, _after_ampersand), "")))


def clean_html(c, max_len: int | None = 600) -> Column:
    """Tags -> space, entities decoded, spacing fixed, cut to ``max_len`` chars.

    Null or empty -> ``''``.
    """
    raw = F.coalesce(_c(c), F.lit(""))
    out = normalize_spaces(decode_entities(strip_tags(raw)))
    return F.substring(out, 1, max_len) if max_len else out


def keyword_pattern(term: str) -> str:
    """Whole-word, case-insensitive (Unicode) pattern for one literal term."""
    return r"(?iuU)\b\Q" + term.replace(r"\E", r"\E\\E\Q") + r"\E\b"


def _fold(c: Column) -> Column:
    """One form of texts that differ in case alone."""
    # nothing is added: it keeps the optimizer from taking ``lower(upper(x))`` for ``lower(x)``
    return F.lower(F.concat(F.upper(F.concat(F.lower(c), F.lit(""))), F.lit("")))


def _trie_pattern(terms: Sequence[str]) -> str:
    """Alternatives that share their beginnings once, longer terms before shorter ones; each ends at a word's end."""
    tree: dict = {}
    for term in terms:
        node = tree
        for char in term:
            node = node.setdefault(char.lower() if len(char.lower()) == 1 else char, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ways = [f"\\Q{char}\\E{pattern(rest)}" if char != "\\" else rf"\\{pattern(rest)}"
                for char, rest in sorted(node.items(), reverse=True) if char]
        ways += [r"\b"] if "" in node else []
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"
    return pattern(tree)


def _with_beginnings(terms: Sequence[str]) -> list[list[int]]:
    """For each term the numbers of those that stand wherever it does, from the same place on: itself and the
    terms that it begins with up to the end of a word."""
    out = []
    for term in terms:
        out.append([i for i, t in enumerate(terms) if t.lower() == term.lower()
                    or len(t) < len(term) and re.match(rf"(?i){re.escape(t)}\b", term)])
    return out


def extract_tags(c, terms: Sequence[str], default: str) -> Column:
    """Terms found as whole words (any case), in list order, joined ``', '``.

    No hit, null or empty text -> ``default``.  The text is searched once, whatever the number of terms: a look-ahead takes
    the longest term at each place, as terms may overlap, and those it begins with follow from it."""
    terms = [t for t in dict.fromkeys(terms) if t]
    if not terms:
        return F.lit(default)
    text = F.coalesce(_c(c), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(rf"(?iuU)(?=\b({_trie_pattern(terms)}))"), 1)
    numbers = F.map_from_entries(F.array_distinct(F.array(*[
        F.struct(_fold(F.lit(t)), F.array(*[F.lit(i) for i in own]))
        for t, own in _one_spelling(terms, _with_beginnings(terms))])))
    hits = F.transform(F.array_distinct(F.transform(found, _fold)), lambda hit: F.try_element_at(numbers, hit))
    names = F.array(*[F.lit(t) for t in terms])

    def listed(of: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.array_distinct(F.flatten(of))), lambda i: F.get(names, i)), ", ")
    # spellings that a pattern takes for a term's, but no folding (a dotted capital I): one pattern a term decides
    each = F.array_join(F.array(*[F.when(text.rlike(keyword_pattern(t)), F.lit(t)) for t in terms]), ", ")
    # a lambda's argument is computed once; a column that is read twice would search twice
    tags = F.transform(F.array(hits), lambda of: F.when(F.exists(of, lambda h: h.isNull()), each).otherwise(listed(of)))
    return F.transform(tags, lambda t: F.when(t == "", F.lit(default)).otherwise(t))[0]


def _one_spelling(terms: Sequence[str], numbers: list[list[int]]) -> list[tuple[str, list[int]]]:
    """The terms without those that differ from an earlier one in case alone."""
    return list({t.lower().upper().lower(): (t, own) for t, own in reversed(list(zip(terms, numbers)))}.values())


# FIXED VALUES: RFC 822 zone names and their offsets in minutes
RFC822_ZONES = {"UT": 0, "GMT": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360,
                "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}


def rfc822_wallclock(c, to_utc: bool = False) -> Column:
    """RFC-822 date -> timestamp; bad -> null.

    By default the wall clock is kept and the zone dropped (T10):
    ``'Mon, 01 Dec 2025 10:30:00 -0300'`` -> 2025-12-01 10:30:00.  With ``to_utc``
    the zone (``+hhmm``/``-hhmm`` or a named RFC 822 zone) is applied:
    -> 2025-12-01 13:30:00.
    """
    s = F.regexp_replace(F.trim(_c(c)), r"^[A-Za-z]+,\s*", "")
    pattern = r"^(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})\s+(\d{1,2}:\d{2}(?::\d{2})?)"
    day, month, year, time = (F.regexp_extract(s, pattern, i) for i in range(1, 5))
    # two digits: 00 to 68 are this century, as POSIX reads them
    year = F.when(F.length(year) == 2, F.concat(F.when(year <= "68", "20").otherwise("19"), year)).otherwise(year)
    body = F.concat_ws(" ", day, F.initcap(month), year, time)
    wall = F.coalesce(F.try_to_timestamp(body, F.lit("d MMM yyyy H:mm:ss")),
                      F.try_to_timestamp(body, F.lit("d MMM yyyy H:mm")))
    if not to_utc:
        return wall
    zone = F.regexp_extract(s, r"\s([+-]\d{4}|[A-Za-z]{1,3})\s*$", 1)
    numeric = F.when(zone.rlike(r"^[+-]\d{4}$"),
                     (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int"))
                     * F.when(zone.startswith("-"), -1).otherwise(1))
    zones = F.create_map(*[F.lit(x) for kv in RFC822_ZONES.items() for x in kv])
    minutes = F.coalesce(numeric, F.try_element_at(zones, F.upper(zone)), F.lit(0))
    return F.timestamp_add("MINUTE", -minutes, wall)
