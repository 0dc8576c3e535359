"""What sources, quotes and parses say about a value: kinds of sources, identities, scopes, layouts, as columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import canonical_domain, fold, has_any, text

# Hosts of managers (parts of names), status codes of absence, words of managers, and bounds.
MANAGER_HOSTS = ["avantfunds", "amista", "codyainvest", "monecois", "jtis", "deltais", "encoram", "tillerfunds", "creditas", "redsidefunds", "bhs", "natland", "conseq", "generali", "raiffeisen", "wood"]
ABSENT = [403, 404, 410]
MANAGER_WORDS = ["vyrocni zprava investicni spolecnosti", "vyrocni zprava spolecnosti", "obhospodarovatel spravuje", "investicni spolecnost spravuje", "aktiva ve sprave skupiny", "seznam obhospodarovanych fondu", "prehled fondu ve sprave", "annual report of the management company"]
BROKEN_ORDER, BARE_TEXT, COLUMNS_SHARE, SERIES_ROWS = 0.33, 2_000, 0.25, 5
BLOCKED_TYPES = ["priips_kid", "financial_statements"]
WORDS_KEPT, EVIDENCE_KEPT, ISINS_KEPT, ORDER_GAIN = 0.97, 0.95, 1.0, 0.05
RANGE_WORDS = ["od ", " do ", " az ", "maximaln", "nejvyse", "up to", "minimaln"]
ZERO_WORDS = ["0 %", "0%", "0,00 %", "0.00 %", "0 czk", "0 eur", "0 usd", "0 kc", "bez poplatku", "neplati zadny", "neni aplikovan zadny", "neuctuje zadny", "nehradi zadny", "zdarma"]
ISIN = r"\b[A-Z]{2}[A-Z0-9]{9}\d\b"
ICO = r"(?<!\d)\d{8}(?!\d)"


def source_kind(url: Column | str, fund_web: Column | str, third_parties: list[str]) -> Column:
    """none, official_website, manager_or_administrator or third_party."""
    own, fund = canonical_domain(url), canonical_domain(F.coalesce(text(fund_web), F.lit("")))
    third = reduce(or_, ((own == t) | F.endswith(own, F.lit("." + t)) for t in third_parties), F.lit(False))
    return F.when(F.coalesce(own, F.lit("")) == "", "none").when((fund != "") & (own == fund), "official_website").when(has_any(own, MANAGER_HOSTS), "manager_or_administrator").when(third, "third_party").otherwise("manager_or_administrator")


def authority(url: Column | str, fund_web: Column | str, names_fund: Column, third_parties: list[str]) -> Column:
    """How close an accepted source stands to the fund."""
    kind = source_kind(url, fund_web, third_parties)
    return F.when(kind == "none", "unknown").when(kind == "official_website", "official_fund").when(names_fund, "fund_specific_manager").when(kind == "third_party", "external_fallback").otherwise("generic_manager")


def fetch_failure(code: Column, status: Column, guessed: Column, document_codes: list[str]) -> Column:
    """An expected miss of an invented address, a document's own fault, or a failure."""
    missed = guessed & (F.coalesce(status.isin(ABSENT), F.lit(False)) | (code == "http_status_error"))
    return F.when(missed, "expected_miss").when(code.isin(document_codes), "warning").otherwise("failure")


def numbers_of(texts: Column, pattern: str) -> Column:
    """Distinct matches in an array of texts."""
    return F.array_distinct(F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(pattern), 0))))


def matching_ico(texts: Column, ico: Column) -> Column:
    return F.when(F.array_contains(numbers_of(texts, ICO), ico), ico)


def foreign_ico(texts: Column, ico: Column) -> Column:
    """The first registration number that isn't the fund's."""
    return F.when(ico.isNotNull(), F.get(F.filter(numbers_of(texts, ICO), lambda n: n != ico), 0))


def identity(own_tokens: Column, named: Column, matched: Column, foreign: Column, manager: Column, foreign_name: Column, share_class: Column, subfund: Column) -> Column:
    """struct(scope, confidence): which entity a document belongs to, from evidence for and against it.

    own_tokens: the fund's distinctive words; named: it names the fund; foreign_name: it names another.
    """
    for_it, against = named | matched.isNotNull(), manager | foreign_name
    exact = F.when(share_class.isNotNull(), "share_class").when(subfund.isNotNull(), "subfund").otherwise("exact_fund")
    scope = (
        F.when((F.size(own_tokens) == 0) & matched.isNull(), "unknown").when(for_it & against, "ambiguous").when(against, F.when(manager, "manager").otherwise("another_fund"))
        .when(~for_it, F.when(foreign.isNotNull(), "another_fund").otherwise("unknown")).otherwise(exact)
    )
    sure = F.when(scope.isin("unknown", "ambiguous"), "low").when(scope.isin("manager", "another_fund"), "medium").when(matched.isNotNull(), "high").otherwise("medium")
    return F.struct(scope.alias("scope"), sure.alias("confidence"))


def value_scope(own_section: Column, foreign_section: Column, title_names: Column, mentions_other: Column, share_class: Column) -> Column:
    """Whose value it is: the section it stands in decides, then the title, then whether others are named at all."""
    return F.when(foreign_section, "another_fund").when(own_section, F.when(share_class.isNotNull(), "share_class").otherwise("exact_fund")).when(title_names & ~mentions_other, "exact_fund").when(mentions_other, "multi_fund").otherwise("unknown")


FORMS = r"(?i)((?:[\p{Lu}][\p{L}\p{N}\-]*\s+){1,8})(SICAV|investiční fond|podfond|fond kvalifikovaných investorů)"


def named_funds(x: Column | str) -> Column:
    """Names of funds in a text: up to eight capitalised words before a legal form."""
    names = F.regexp_extract_all(text(x), F.lit(FORMS.replace("(?i)", "")), 1)
    return F.array_distinct(F.transform(names, lambda n: F.trim(n)))


def layout_triggers(document_format: Column, pages: Column, parser: Column, broken: Column, characters: Column, labelled_rows: Column, multi_column: Column) -> Column:
    """Why a PDF's text may be worth a second reading."""
    own = F.array(
        F.when(~F.contains(parser, F.lit("ocr")) & (parser != "pymupdf"), "parser_ladder_fallback"),
        F.when(broken >= BROKEN_ORDER, "broken_reading_order"),
        F.when((characters >= BARE_TEXT) & (labelled_rows == 0), "text_without_tables"),
        F.when(multi_column >= COLUMNS_SHARE, "multi_column_layout"),
    )
    return F.when((document_format == "pdf") & (pages > 0), F.filter(own, lambda t: t.isNotNull())).otherwise(F.array().cast("array<string>"))


def blocking_reason(kind: Column, fee_rows: Column, year_rows: Column) -> Column:
    """Why a document keeps its first parse, null if it need not."""
    return F.when(F.lower(F.trim(kind)).isin(BLOCKED_TYPES), "document_type").when(fee_rows > 0, "fee_rows").when(year_rows >= SERIES_ROWS, "year_rows")


def second_reading(words_kept: Column, evidence_kept: Column, isins_kept: Column, broken_before: Column, broken_after: Column, tables_before: Column, tables_after: Column) -> Column:
    """struct(accepted, improvements, regressions) of a second parse against the first."""
    better = F.array(F.when(broken_before - broken_after >= ORDER_GAIN, "reading_order"), F.when(tables_after > tables_before, "tables"))
    worse = F.array(F.when(words_kept < WORDS_KEPT, "words_lost"), F.when(evidence_kept < EVIDENCE_KEPT, "evidence_lost"), F.when(isins_kept < ISINS_KEPT, "isins_lost"), F.when(tables_after < tables_before, "tables_lost"), F.when(broken_after - broken_before >= ORDER_GAIN, "reading_order_lost"))
    there = lambda a: F.filter(a, lambda v: v.isNotNull())
    return F.struct(((F.size(there(better)) > 0) & (F.size(there(worse)) == 0)).alias("accepted"), there(better).alias("improvements"), there(worse).alias("regressions"))


def states_number(basis: Column | str, n: Column) -> Column:
    """Whether a text holds a number in either decimal style."""
    plain = F.regexp_replace(F.format_number(n, 4), r"(?:\.0+|(\.\d*?[1-9])0+)$", "$1")
    plain = F.replace(plain, F.lit(","), F.lit(""))
    return F.contains(text(basis), plain) | F.contains(text(basis), F.replace(plain, F.lit("."), F.lit(",")))


def written_forms(n: Column) -> Column:
    """How an amount may be written: in units, thousands, millions and billions, with blanks, dots or nothing between groups."""
    scaled = F.filter(F.transform(F.array(*map(F.lit, [1.0, 1e3, 1e6, 1e9])), lambda s: n / s), lambda v: (v >= 1) & (v == F.floor(v)))
    forms = F.transform(scaled, lambda v: F.array(F.format_number(v, 0), F.replace(F.format_number(v, 0), F.lit(","), F.lit(" ")), F.replace(F.format_number(v, 0), F.lit(","), F.lit(".")), F.replace(F.format_number(v, 0), F.lit(","), F.lit(""))))
    return F.array_distinct(F.flatten(forms))


def collapsed_fees(rates: Column) -> Column:
    """Whether a line's fees are one rate copied: two or more, all the same and not zero."""
    return (F.size(rates) >= 2) & (F.size(F.array_distinct(rates)) == 1) & (F.get(rates, 0) != 0)


def zero_fee(rate: Column, basis: Column, labels: Column) -> Column:
    """What is wrong with a fee of zero: no text, a range's lower bound, no word of zero, or another fee's line."""
    b = fold(F.coalesce(basis, F.lit("")))
    named = F.size(labels) == 0
    return F.when(rate == 0, F.when(b == "", "zero_fee_without_evidence").when(has_any(b, RANGE_WORDS), "zero_fee_from_a_range").when(~has_any(b, ZERO_WORDS), "zero_fee_not_supported_by_source").when(~named & ~F.exists(labels, lambda w: F.contains(b, w)), "zero_fee_of_another_fee_type"))


def fees_key(items: Column) -> Column:
    """What two fee schedules have in common if they are one: their items, sorted, without their order."""
    return F.sha2(F.to_json(F.array_sort(F.array_distinct(items))), 256)


def fees_text(items: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(items, lambda i: F.concat(i["type"], F.lit(" "), F.coalesce(F.concat(i["rate"].cast("string"), F.lit(" %")), F.lit("?"))))), ", ")


def signature(*columns: Column) -> Column:
    """A value's canonical JSON: fields in a fixed order."""
    return F.to_json(F.struct(*columns))


def is_html(content_type: Column | str, body: Column | str) -> Column:
    return F.contains(F.lower(F.coalesce(text(content_type), F.lit(""))), F.lit("html")) | F.lower(F.ltrim(F.substring(body, 1, 512))).rlike("^(<!doctype html|<html)")


def anchors(x: Column | str) -> Column:
    """Distinct words and numbers of six letters or more, by which passages are found again."""
    return F.array_distinct(F.regexp_extract_all(text(x), F.lit("[0-9A-Za-zÀ-ž]{6,}"), 0))


def isin_scope(isins: Column, register: Column) -> Column:
    """The narrowest scope of a text's ISINs in a register map (ISIN -> struct(own, scope)); a foreign one vetoes."""
    known = F.filter(F.transform(isins, lambda i: F.try_element_at(register, i)), lambda r: r.isNotNull())
    rank = lambda r: F.struct(F.when(r["scope"] == "share_class", 0).when(r["scope"] == "subfund", 1).otherwise(2).alias("n"), r["scope"].alias("scope"))
    return F.when(F.exists(known, lambda r: ~r["own"]), F.lit(None).cast("string")).otherwise(F.array_min(F.transform(known, rank))["scope"])


@F.arrow_udf(T.StringType())
def decoded(bodies: pa.Array) -> pa.Array:
    """Bytes of a page as text: by its declared charset, else UTF-8, windows-1250, ISO-8859-2."""
    import re

    out = []
    for body in bodies.to_pylist():
        if body is None:
            out.append(None)
            continue
        named = re.search(rb"charset=[\"']?([A-Za-z0-9_-]+)", body[:2048])
        for charset in [*([named[1].decode()] if named else []), "utf-8", "cp1250", "iso-8859-2"]:
            try:
                out.append(body.decode(charset))
                break
            except (LookupError, UnicodeDecodeError):
                continue
        else:
            out.append(body.decode("utf-8", "replace"))
    return pa.array(out, pa.string())


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())])))
def markdown_chunks(rows: pa.Array) -> pa.Array:
    """Paragraphs and tables of Markdown in order."""
    out = []
    for x in rows.to_pylist():
        parts: list[dict] = []
        for block in (x or "").replace("\r", "").split("\n\n"):
            lines = [line.rstrip() for line in block.split("\n") if line.strip()]
            k = 0
            while k < len(lines):
                table = lines[k].lstrip().startswith("|")
                at = k
                while k < len(lines) and lines[k].lstrip().startswith("|") == table:
                    k += 1
                parts.append({"kind": "table" if table else "paragraph", "text": "\n".join(lines[at:k])})
        out.append(parts)
    return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())])))


@F.arrow_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))
def html_tables(pages: pa.Array) -> pa.Array:
    """Innermost tables of at least 2 by 2 cells, at most 40 rows of 200 cells (the feature's caps)."""
    from html.parser import HTMLParser

    class Tables(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.done = [], []

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                if self.open:
                    self.open[-1]["inner"] = True
                self.open.append({"rows": [], "inner": False, "cell": False})
            elif self.open and tag == "tr":
                self.open[-1]["rows"].append([])
            elif self.open and tag in ("td", "th") and self.open[-1]["rows"]:
                self.open[-1]["rows"][-1].append("")
                self.open[-1]["cell"] = True

        def handle_endtag(self, tag):
            if tag == "table" and self.open:
                t = self.open.pop()
                rows = [[" ".join(c.split()) for c in r[:200]] for r in t["rows"][:40] if r]
                if not t["inner"] and len(rows) >= 2 and max(map(len, rows)) >= 2:
                    self.done.append(rows)
            elif tag in ("td", "th") and self.open:
                self.open[-1]["cell"] = False

        def handle_data(self, data):
            if self.open and self.open[-1]["cell"]:
                self.open[-1]["rows"][-1][-1] += data

    out = []
    for page in pages.to_pylist():
        p = Tables()
        p.feed(page or "")
        out.append(p.done)
    return pa.array(out, pa.list_(pa.list_(pa.list_(pa.string()))))


