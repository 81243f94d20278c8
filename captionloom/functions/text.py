"""Text functions on columns: cleaning, normal forms, boundaries, joins, splits and hints."""

from __future__ import annotations

import html.entities
import string
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: closing marks, terminal and clause marks, letters of the lexical form, spacing rules, markers
CLOSERS = "[\"”’'»)\\]]"
TERMINAL = f"[.!?…]+({CLOSERS}+)?$"
CLAUSE = f"[,;:]+({CLOSERS}+)?$"
NOT_LEXICAL = "(?U)[^0-9a-zA-ZÀ-ỹĐđ\\s]"
TOKEN = "[0-9A-Za-zÀ-ỹĐđ]+"
#: The initial of a token of two characters or more, and four equal ones of five in a row.
INITIAL, CROWD = f"({TOKEN[:-1]}){TOKEN}", "(.)(?:\\1\\1\\1|.\\1\\1\\1|\\1.\\1\\1|\\1\\1.\\1)"
#: White space of any kind, the marks that are no part of a token, and a token that follows itself between spaces.
SPACES, MARKS = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000", string.punctuation + "…"
REPEAT = " ([^ ]++) +\\1 "
NO_SPACE_BEFORE = "^[,.;:!?…%)\\]}”’»]"
NO_SPACE_AFTER = "[(\\[{“‘«]$"
EVENT_TIGHT = " \n,.?!…:;)]}"
#: What clean() changes or takes away.
UNCLEAN = "[& \\t\\r\\f\\n\\x0B\u200b\ufeff]"
MOJIBAKE = ("Ã", "Â", "Ä", "Æ", "á»", "áº", "â€", "ðŸ", "�")
#: A sentence mark with its closers, before white space or the end.
INNER_BOUNDARY = "((?:[.!?]+|…+)[\"”’»)\\]]*)(?=(?U:\\s)|$)"
SENTENCE = "((?s).*?[.!?…]+[\"”’'»)\\]]*(?=(?U:\\s)|$))"


def spelt(names: list[str]) -> str:
    """A pattern for the longest of the names that a text begins with: their prefix tree, which is left at the first character that
    no name has."""
    by_first: dict[str, list[str]] = {}
    for name in names:
        if name:
            by_first.setdefault(name[0], []).append(name[1:])
    branches = []
    for first, rest in sorted(by_first.items()):
        below = spelt(rest)
        branches.append(f"{first}(?:{below}){'?' if '' in rest else ''}" if below else first)
    return "|".join(branches)


def entity_buckets() -> list[str]:
    """The named character references of HTML by a hash: each bucket is a text of names and their characters."""
    buckets: list[list[str]] = [[] for _ in range(ENTITY_BUCKETS)]
    for k, v in sorted(html.entities.html5.items()):
        buckets[zlib.crc32(k.encode()) % ENTITY_BUCKETS].append(f"\u0002{k}\u0001{v}")
    return ["".join(b) for b in buckets]


ENTITY_BUCKETS = 2048
#: The longest name at the beginning of a text, and all names with their characters as one constant of the plan.
ENTITY_NAME, ENTITIES = f"^(?:{spelt(list(html.entities.html5))})", "\u0003".join(entity_buckets())


def numeric_reference(code: Column) -> Column:
    """The character of a number in a reference, by the rules of HTML: bytes that are no control characters are windows-1252,
    what is no character is a replacement mark or nothing."""
    # the 32 codes after 127, of which five have no character in windows-1252
    western = F.array(*(F.lit(bytes([k]).decode("cp1252", "ignore") or chr(k)) for k in range(0x80, 0xA0)))
    low = F.pmod(code, F.lit(0x10000))
    nothing = code.between(1, 8) | code.between(0x0E, 0x1F) | (code == 0x0B) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(0x20, 0x7E), F.char(code))
        .when(code.between(0x80, 0x9F), F.get(western, (code - 0x80).cast("int")))
        .when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(nothing, "")
        .otherwise(plain)
    )


def unescape(text: Column) -> Column:
    """All named and numeric HTML references, each once, without leaving the JVM. A text without & is handed on as it is.

    A value that is named more than once is bound by a function of its own, which names no variable of outer ones: Spark does
    not find a Python function above such a text."""
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))

    def numeric(piece: Column, digits: str, base: int) -> Column:
        """More than seven digits after the zeros exceed every character."""
        short = F.regexp_extract(piece, f"^#[xX]?0*({digits}*)", 1)
        code = once(short, lambda d: F.when(F.length(d) > 7, 0x110000).when(d == "", 0).otherwise(F.conv(d, base, 10).cast("long")))
        return F.concat(once(code, numeric_reference), F.regexp_replace(piece, f"^#[xX]?{digits}+;?", ""))

    def name(piece: Column) -> Column:
        # the name, the bucket that may have it, and what follows it
        parts = F.struct(F.regexp_extract(piece, ENTITY_NAME, 0).alias("name"), piece.alias("piece"))

        def of(p: Column) -> Column:
            bucket = F.get(F.split(F.lit(ENTITIES), "\u0003"), F.pmod(F.crc32(p["name"].cast("binary")), F.lit(ENTITY_BUCKETS)).cast("int"))
            own = F.call_function("substring_index", bucket, F.concat(F.lit("\u0002"), p["name"], F.lit("\u0001")), F.lit(-1))
            found = F.concat(F.substring_index(own, "\u0002", 1), F.substring(p["piece"], F.length(p["name"]) + 1, F.length(p["piece"])))
            return F.when(p["name"] == "", F.concat(F.lit("&"), p["piece"])).otherwise(found)

        return once(parts, of)

    def one(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("#"), name(piece))
            .when(piece.rlike("^#[0-9]"), numeric(piece, "[0-9]", 10))
            .when(piece.rlike("^#[xX][0-9a-fA-F]"), numeric(piece, "[0-9a-fA-F]", 16))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces_ = F.split(text, "&", -1)
    back = F.concat(F.get(pieces_, F.lit(0)), F.array_join(F.transform(F.slice(pieces_, F.lit(2), F.size(pieces_)), one), ""))
    return F.when(text.contains("&"), back).otherwise(text)


def clean(text: Column) -> Column:
    """Entities, zero-width characters and runs of white space within a line; line feeds stay inside."""
    text = F.regexp_replace(F.translate(unescape(text), "\u200b\ufeff", ""), "[ \\t\\r\\f\\x0B]+", " ")
    return F.regexp_replace(text, "^[ \\n]+|[ \\n]+$", "")


def squeeze(text: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, "(?U)\\s+", " "))


def lexical(text: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(clean(text)), NOT_LEXICAL, " "))


def lexical_tokens(text: Column) -> Column:
    form = lexical(text)
    return F.when(form == "", F.array().cast("array<string>")).otherwise(F.split(form, " "))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def is_terminal(text: Column) -> Column:
    return text.rlike(TERMINAL)


def is_clause(text: Column) -> Column:
    return text.rlike(CLAUSE)


def join_words(words: Column) -> Column:
    """Words of an array with single spaces, but none before closing or after opening marks."""
    kept = F.filter(F.transform(words, lambda w: F.when(w.rlike(UNCLEAN), clean(w)).otherwise(w)), lambda w: w != "")
    # what follows an opening mark is a line's end at most, so the whole text is not searched for each word
    glue = lambda out, w: (out == "") | w.rlike(NO_SPACE_BEFORE) | F.right(out, F.lit(3)).rlike(NO_SPACE_AFTER)
    return clean(F.aggregate(kept, F.lit(""), lambda out, w: F.when(glue(out, w), F.concat(out, w)).otherwise(F.concat(out, F.lit(" "), w))))


def join_events(parts: Column) -> Column:
    """Caption texts in order, with a space unless white space or a closing mark is there. Each is looked at beside the one before
    that is not empty, so that the whole text is built once."""
    tight = lambda e, before: (before == "") | F.right(before, F.lit(1)).isin(" ", "\n") | F.left(e, F.lit(1)).isin(*EVENT_TIGHT)
    glued = lambda e, before: F.when(tight(e, before), e).otherwise(F.concat(F.lit(" "), e))
    # the array moved on by one is one longer: its last pair is null and is left out
    joined = lambda kept: F.array_join(F.zip_with(kept, F.concat(F.array(F.lit("")), kept), glued), "")
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    return once(parts, lambda ps: F.when(~F.exists(ps, lambda e: e.isNull()), once(F.filter(ps, lambda e: e != ""), joined)))


def hms(seconds: Column) -> Column:
    """HH:MM:SS.mmm; negative times are zero."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    part = lambda div, mod: F.pmod(F.floor(ms / div), F.lit(mod))
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), part(60_000, 60), part(1000, 60), F.pmod(ms, F.lit(1000)))


def split_pieces(text: Column) -> Column:
    """Array of (char_start, char_end, piece): cuts after sentence marks before white space; nothing but white
    space is lost. Offsets are code points of the text."""
    marked = F.split(F.regexp_replace(text, INNER_BOUNDARY, "$1\u0001"), "\u0001")
    empty = F.array().cast("array<struct<char_start:int,char_end:int,piece:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(state: Column, raw: Column) -> Column:
        # most have no white space but spaces at their ends
        other = F.concat(F.left(F.trim(raw), F.lit(1)), F.right(F.trim(raw), F.lit(1))).rlike("(?U)\\s")
        piece = F.when(other, F.regexp_replace(raw, "(?U)^\\s+|\\s+$", "")).otherwise(F.trim(raw))
        lead = F.length(raw) - F.length(F.when(other, F.regexp_replace(raw, "(?U)^\\s+", "")).otherwise(F.ltrim(raw)))
        begin = (state["at"] + lead).cast("int")
        row = F.struct(begin.alias("char_start"), (begin + F.length(piece)).cast("int").alias("char_end"), piece.alias("piece"))
        return F.struct(
            (state["at"] + F.length(raw)).cast("int").alias("at"),
            F.when(piece == "", state["found"]).otherwise(F.concat(state["found"], F.array(row))).alias("found"),
        )

    return F.aggregate(marked, start, step, lambda state: state["found"])


def complete_sentences(text: Column) -> Column:
    """Sentences with their marks; what follows the last mark is dropped."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(1)), squeeze), lambda s: s != "")


def bound(value: Column, test) -> Column:
    """test(value), with value computed once however often the test names it."""
    return F.exists(F.array(value), test)


def repeated_token(text: Column) -> Column:
    """Whether a white-space token follows itself, without marks at its ends and in lower case.

    Tokens are cut and stripped one by one only where a token without any marks follows itself, which one pattern finds."""
    words = F.transform(F.split(squeeze(F.lower(text)), " "), lambda w: F.regexp_replace(w, "^[\\p{Punct}…]+|[\\p{Punct}…]+$", ""))
    follows = lambda ws: F.exists(F.zip_with(ws, F.slice(ws, F.lit(2), F.size(ws)), lambda a, b: (a != "") & (a == b)), lambda p: p)
    bare = F.concat(F.lit(" "), F.translate(F.lower(text), SPACES + MARKS, " " * len(SPACES)), F.lit(" "))
    return F.when(bare.rlike(REPEAT), bound(words, lambda ws: F.coalesce(follows(ws), F.lit(False)))).otherwise(False)


def crowded_initials(text: Column) -> Column:
    """Whether in some five tokens of two characters or more one initial occurs four times or more."""
    initials = F.regexp_extract_all(F.lower(text), F.lit(INITIAL), F.lit(1))
    return bound(F.array_join(initials, ""), lambda h: F.coalesce((F.length(h) >= 5) & h.rlike(CROWD), F.lit(False)))


def mojibake_count(text: Column) -> Column:
    total = F.lit(0)
    for marker in MOJIBAKE:
        total = total + (F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / len(marker)
    return total.cast("int")


def seeded_order(key: Column, seed: int) -> Column:
    """A fixed pseudo-random order that any SQL engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))
