"""Text as columns: folding, tokens, names and addresses."""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import or_
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labels import DOCUMENT_VOCABULARY, OTHER_FUND_MARKERS

#: Letters with marks of European languages. Both strings have one letter for one.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćĈĉĊċČčĎďĒēĔĕĖėĘęĚěĜĝĞğĠġĢģĤĥĨĩĪīĬĭĮįİĴĵĶķĹĺĻļĽľŃńŅņŇňŌōŎŏŐőŔŕŖŗŘřŚśŜŝŞşŠšŢţŤťŨũŪūŬŭŮůŰűŲųŴŵŶŷŸŹźŻżŽž"
PLAIN = "".join(unicodedata.normalize("NFKD", c)[0] for c in MARKED)
#: White space of Unicode, in Java's regular expressions.
SPACES = r"[\s\u0085   -     　\u001c-\u001f]+"


def text(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(x: Column, f) -> Column:
    """f(x) with x evaluated once, however often f names it: keeps plans and generated code small."""
    return F.get(F.transform(F.array(x), f), 0)


def without_marks(x: Column | str) -> Column:
    """Letters without their marks, one for one."""
    return F.translate(text(x), MARKED, PLAIN)


def fold_keeping_space(x: Column | str) -> Column:
    """Small letters without marks; white space as it is."""
    return F.replace(F.lower(without_marks(x)), F.lit("ß"), F.lit("ss"))


def fold(x: Column | str) -> Column:
    """Text as keywords are looked for in it: small letters without marks, single blanks, none at the ends."""
    return F.trim(F.regexp_replace(fold_keeping_space(x), SPACES, " "))


def fold_aligned(x: Column | str) -> Column:
    """Folded text of the same length, so that places in it are places in the text."""
    return F.lower(without_marks(x))


@F.arrow_udf(T.StringType())
def fold_exactly(rows: pa.Array) -> pa.Array:
    """`fold` for any script: compatibility forms too, which no built-in function knows."""
    out = []
    for x in rows.to_pylist():
        if x is not None:
            x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
            x = " ".join(x.casefold().split())
        out.append(x)
    return pa.array(out, pa.string())


def has_any(x: Column | str, words: list[str]) -> Column:
    """Whether text holds one of the words."""
    return reduce(or_, (F.contains(text(x), F.lit(w)) for w in words), F.lit(False))


def extracted(x: Column | str) -> Column:
    """Text of a page: blanks of all kinds as one, no soft hyphens, at most one empty line, no ends."""
    x = F.translate(text(x), " ­\r", " ")
    x = F.regexp_replace(x, r"[ \t\f\u000b]+", " ")
    x = F.regexp_replace(x, r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


# --- addresses


def host(url: Column | str) -> Column:
    """The host of an address in small letters, without user and port; '' without one."""
    part = F.regexp_extract(F.trim(text(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.lower(part)


def running_sums(numbers: Column) -> Column:
    """Sums of an array's first 1, 2, ... whole numbers, in blocks of 256 so that long arrays stay cheap; not for empty arrays."""
    add = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    zero = F.lit(0).cast("long")

    def blocked(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(own) / 256).cast("int") - 1), lambda c: F.slice(own, c * 256 + 1, 256))

        def summed(parts: Column) -> Column:
            sums = F.transform(parts, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
            based = lambda bases: F.flatten(F.transform(parts, lambda b, k: F.slice(F.aggregate(b, F.array(F.get(bases, k)), add), 2, 256)))
            return once(F.aggregate(sums, F.array(zero), add), based)

        return once(blocks, summed)

    return once(F.transform(numbers, lambda x: x.cast("long")), blocked)


def canonical_domain(url: Column | str) -> Column:
    """The host by which addresses are grouped: without a leading www."""
    return F.regexp_replace(host(url), r"^www\.", "")


def canonical_url(url: Column | str) -> Column:
    """An address for telling duplicates: scheme and host in small letters, no default port, fragment or closing slash."""
    url = F.trim(text(url))
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    port = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*):(\d+)", 1)
    plain = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.when(F.regexp_replace(rest, "/+$", "") == "", F.when(rest.rlike("^/{2,}$"), F.lit("")).otherwise(F.lit("/"))).otherwise(F.regexp_replace(rest, "/+$", ""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    whole = F.concat(scheme, F.lit("://"), host(url), F.when(plain, F.lit("")).otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(host(url) == "", F.regexp_replace(url, "#+$", "")).otherwise(whole)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def file_name(url: Column | str) -> Column:
    """The last part of an address's path, decoded."""
    return F.coalesce(F.try_url_decode(F.regexp_extract(url_path(url), r"([^/]*)/*$", 1)), F.lit(""))


def file_name_words(url: Column | str) -> Column:
    """The file name of an address in folded words, without its ending."""
    return fold(F.regexp_replace(F.regexp_replace(file_name(url), r"(?<=.)\.[^.]*$", ""), r"[-_.+]", " "))


def url_words(url: Column | str) -> Column:
    """Path and query of an address in folded words."""
    query = F.regexp_extract(text(url), r"^[^?#]*\?([^#]*)", 1)
    return fold(F.regexp_replace(F.coalesce(F.try_url_decode(F.concat_ws(" ", url_path(url), query)), F.lit("")), r"[-_/.+]", " "))


def joined_url(base: Column | str, href: Column | str) -> Column:
    """href against base, where it is absolute, of the same scheme, rooted or beside the page; null for other kinds."""
    href, base = F.trim(text(href)), text(base)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"[^/]*$", "")
    return (
        F.when(href.rlike("(?i)^https?://"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.rlike(r"^(#|$)|^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(root) + 1, folder).otherwise(F.concat(root, F.lit("/"))), href))
    )


@F.arrow_udf(T.StringType())
def resolved_url(bases: pa.Array, hrefs: pa.Array) -> pa.Array:
    """href against base by all rules (dots, queries), without its fragment; null for contact and asset addresses."""
    out = []
    for base, href in zip(bases.to_pylist(), hrefs.to_pylist()):
        try:
            url = urljoin(base or "", (href or "").strip()).split("#")[0]
            good = href and href.strip() and not href.strip().startswith("#") and url.lower().startswith(("http://", "https://"))
            out.append(url if good else None)
        except ValueError:
            out.append(None)
    return pa.array(out, pa.string())


# --- names

#: Words that don't tell one fund from another.
GENERIC_WORDS = ["as", "sicav", "fond", "fondy", "fund", "funds", "investicni", "investment", "investments", "invest", "spolecnost", "company", "podfond", "subfund", "otevreny", "uzavreny", "promennym", "zakladnim", "kapitalem", "cesky", "czech"]
#: Fixed value: legal forms.
LEGAL_FORM = r"(?i)[,\s]*\b(?:sicav|a\.?\s?s\.?|s\.?\s?r\.?\s?o\.?|k\.?\s?s\.?|se|plc|ltd\.?|gmbh|ag)(?=$|[\s,.)])"


def words(x: Column | str) -> Column:
    """Distinct folded words, in order."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(fold(x), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != ""))


def distinctive_tokens(x: Column | str, shortest: int = 3, generic: list[str] = GENERIC_WORDS) -> Column:
    """Distinct folded words of `shortest` letters that aren't generic."""
    return F.array_except(F.filter(words(x), lambda w: F.length(w) >= shortest), F.array(*map(F.lit, generic)))


def entity_key(x: Column | str) -> Column:
    """Words without digits, joined."""
    return F.array_join(F.filter(words(x), lambda w: ~w.rlike("[0-9]")), "")


def company_key(x: Column | str) -> Column:
    """What two spellings of a company's name have in common: its folded letters and digits."""
    return F.regexp_replace(fold(x), r"[^\p{L}\p{N}]", "")


def without_legal_forms(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(text(x), LEGAL_FORM, ""))


def search_queries(name: Column | str, most: int = 4) -> Column:
    """Distinct spellings of a name to search for, at most `most`."""
    short = without_legal_forms(name)
    return F.slice(F.array_distinct(F.array(F.trim(text(name)), short, F.concat(short, F.lit(" fond")), F.concat_ws(" ", distinctive_tokens(name)))), 1, most)


def name_phrases(x: Column | str, least: int = 2) -> Column:
    """All runs of at least `least` words of a name that hold each of its distinctive words."""
    own, key = words(x), distinctive_tokens(x)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(own)), lambda a: F.transform(F.sequence(a, F.size(own)), lambda b: F.slice(own, a, b - a + 1))))
    good = F.filter(runs, lambda r: (F.size(r) >= least) & (F.size(F.array_except(key, r)) == 0))
    return F.when(F.size(own) > 0, F.transform(good, lambda r: F.array_join(r, " "))).otherwise(F.array().cast("array<string>"))


def domain_guesses(x: Column | str, endings: tuple[str, ...] = ("cz", "eu", "com"), most: int = 12) -> Column:
    """Addresses a fund of this name might have: bases by endings, distinct, at most `most`."""
    key = distinctive_tokens(x)
    bases = F.array_distinct(F.filter(F.array(F.array_join(key, ""), F.array_join(key, "-"), F.concat(F.array_join(key, ""), F.lit("sicav")), F.get(key, 0)), lambda b: b.isNotNull() & (b != "")))
    return F.slice(F.flatten(F.transform(bases, lambda b: F.transform(F.array(*map(F.lit, endings)), lambda e: F.concat(b, F.lit("."), e)))), 1, most)


def registration_number(x: Column | str) -> Column:
    """Eight digits of a registration number, null if there are more or fewer."""
    digits = F.regexp_replace(text(x), r"[^0-9]", "")
    return F.when(F.length(digits) == 8, digits)


def share_class(x: Column | str) -> Column:
    """The code of a share class that text names: after its label, else the first bare code of capitals."""
    labelled = F.regexp_extract(text(x), r"(?:[Tt]ř[ií]d[ayu]|[Tt]rid[ayu]|[Cc]lass)\s+([A-Z][A-Z0-9]{0,4})(?![\p{L}\p{N}])", 1)
    bare = F.regexp_extract(text(x), r"(?<![\p{L}\p{N}])(PIA|VIA|RIA|DIA|[A-Z]{1,2}[0-9])(?![\p{L}\p{N}])", 1)
    return F.nullif(F.coalesce(F.nullif(labelled, F.lit("")), bare), F.lit(""))


def without_emphasis(x: Column | str) -> Column:
    """Markdown without its marks of emphasis."""
    return F.regexp_replace(F.regexp_replace(text(x), r"\*\*|__", ""), r"\*(\S(?:[^*\n]*\S)?)\*", "$1")


def cut_party_name(x: Column | str, most_words: int = 12) -> Column:
    """A company's name without leading connectives and dates; null for sentences and long texts."""
    lead = r"^(?:(?:je|jsou|is|the|spolecnost|společnost|ke dni|k|od|dne|\d{1,2}\.\s?\d{1,2}\.\s?\d{4}|[-–:;,.])\s*)+(?=\S)"
    name = F.trim(F.regexp_replace(F.trim(text(x)), "(?iu)" + lead, ""))
    sentence = (F.size(F.split(name, r"\s+")) > most_words) | name.rlike(r"[.!?]\s+\p{Ll}") | (name == "")
    return F.when(~sentence, name)


def tokens_match(a: Column, b: Column) -> Column:
    """Equal, or one inside the other where that one has four letters."""
    inside = lambda x, y: (F.length(x) >= 4) & F.contains(y, x)
    return (a == b) | inside(a, b) | inside(b, a)


def link_names_another(name: Column | str, anchor: Column | str, url: Column | str) -> Column:
    """Whether a link speaks of a fund, and of none that shares a word or a fragment with `name`.

    Only links with a word for funds are judged; what isn't vocabulary of documents is the name. A name or a
    link without such words decides nothing.
    """
    own = distinctive_tokens(name)
    words = F.trim(F.concat_ws(" ", fold(anchor), url_words(url)))
    named = F.array_distinct(F.regexp_extract_all(words, F.lit("[a-z]{3,}"), 0))
    named = F.array_except(named, F.array(*map(F.lit, GENERIC_WORDS + DOCUMENT_VOCABULARY)))
    some = F.exists(named, lambda n: F.exists(own, lambda o: tokens_match(n, o)))
    return has_any(words, OTHER_FUND_MARKERS) & (F.size(own) > 0) & (F.size(named) > 0) & ~some


# --- quality of a text


def broken_ratio(x: Column | str) -> Column:
    """Ends of sentences that go on in small letters, against all that go on; 0 without any."""
    broken = F.regexp_count(text(x), F.lit(r"[.!?]\s+\p{Ll}"))
    whole = F.regexp_count(text(x), F.lit(r"[.!?]\s+[\p{Lu}0-9]"))
    return F.coalesce(F.try_divide(broken, broken + whole), F.lit(0.0))


def evidence(x: Column | str) -> Column:
    """Distinct years, days, percentages and ISINs of a text."""
    every = lambda p: F.array_distinct(F.regexp_extract_all(text(x), F.lit(p), 0))
    return F.concat(every(r"\b(?:19[89]\d|20[0-4]\d)\b"), every(r"\b\d{1,2}\s*\.\s*\d{1,2}\s*\.\s*(?:19|20)\d{2}\b"), every(r"-?\d{1,3}(?:[\u00a0 ]?\d{3})*(?:[.,]\d+)?\s*%"), every(r"\b[A-Z]{2}[A-Z0-9]{9}\d\b"))


def without_figures(x: Column | str) -> Column:
    """Text whose lines with a digit are empty; each line is searched from its start only, so work grows with its length."""
    return F.regexp_replace(text(x), r"(?md)^[^\n0-9]*+[0-9][^\n]*+", "")


def retention(a: Column, b: Column) -> Column:
    """The share of a's values that b holds; 1 if a has none."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a)))
