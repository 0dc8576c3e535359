"""Schemas of records, and the conditions that their values must meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    """A struct type from DDL; needs a running session."""
    return T.StructType.fromDDL(ddl)


FUND = "name string, web string"
FALLBACK_SOURCE = "name string, base_url string, source_type string, priority int, enabled boolean, supported_fields array<string>"
EVIDENCE = "struct<source:struct<url:string,title:string,document_type:string,retrieved_at:string,sha256:string>,quote:string,page:int>"
EXTRACTION = "struct<method:string,confidence:string,review_required:boolean>"


def field_result(value: str) -> str:
    """A field of a record with a value of the given type."""
    return f"struct<status:string,value:{value},raw_value:string,scope:string,source:{EVIDENCE},extraction:{EXTRACTION},reason:struct<code:string,detail:string>,attempted_sources:array<struct<url:string,reason:string>>>"


VALUES = {
    "investment_horizon": "struct<recommended_years:double,kind:string>",
    "minimum_investment": "struct<amount:double,currency:string>",
    "target_return": "struct<value_percent_pa:double,minimum_percent_pa:double,maximum_percent_pa:double,return_type:string>",
    "fees": "struct<items:array<struct<type:string,rate_percent:double,minimum_rate_percent:double,maximum_rate_percent:double,maximum:boolean,fixed_amount:double,currency:string,tiers:array<struct<from_month:int,to_month:int,rate_percent:double,amount:double,currency:string>>>>>",
    "assets_under_management": "struct<amount:double,currency:string,metric_type:string,as_of:date>",
    "manager": "struct<name:string,ico:string>",
    "administrator": "struct<name:string,ico:string>",
    "aum_history": "struct<observations:array<struct<amount:double,currency:string,metric_type:string,as_of:date,share_class:string>>>",
    "annual_returns": "struct<observations:array<struct<year:int,return_percent:double,series_type:string,share_class:string,currency:string>>>",
    "historical_values": "struct<series:array<struct<value_type:string,share_class:string,currency:string,frequency:string,observations:array<struct<as_of:date,value:double>>>>>",
    "news": "struct<items:array<struct<title:string,url:string,published_at:date>>>",
}
RECORD = "fund_id string, name string, web string, " + ", ".join(f"{k} {field_result(v)}" for k, v in VALUES.items()) + ", processing struct<status:string,updated_at:string>"
PARSED_DOCUMENT = "source_id bigint, fund_id string, url string, document_format string, parser_name string, page_count int, character_count int, scanned_candidate boolean, pages array<struct<page_number:int,text:string,character_count:int,blocks:array<struct<order:int,x0:double,y0:double,x1:double,y1:double,text:string>>,tables:array<struct<rows:array<array<string>>>>>>"
FINDING = "fund_id string, fund_name string, field string, status string, reason_code string, severity string, source_type string, source_scope string, detail string"
AUDIT = f"input_sha256 string, ruleset_version string, summary struct<funds:int,fields_checked:int>, findings array<struct<{', '.join(x.replace(' ', ':', 1) for x in FINDING.split(', '))}>>"
PACKETS = "packets array<struct<packet_id:string,fund_id:string,field:string,snippets:array<struct<snippet_id:string,source_id:bigint,page:int,score:int,quote:string>>>>"
DECISIONS = "decisions array<struct<packet_id:string,decision:string,value:string,snippet_ids:array<string>>>"


def fund_id(name: Column, canonical: Column) -> Column:
    """A fund's identity: a hash of its name and canonical address."""
    return F.concat(F.lit("fund_"), F.left(F.sha2(F.concat(F.trim(name), F.lit("\n"), F.coalesce(canonical, F.lit(""))), 256), F.lit(16)))


def field_state_errors(field: str) -> Column:
    """What is wrong with a field's state: found needs value, source and extraction and no reason; pending nothing; others a reason and no value."""
    f = lambda k: F.col(f"{field}.{k}")
    found, pending = f("status") == "found", f("status") == "pending"
    has = lambda k: f(k).isNotNull()
    checks = [
        F.when(found & ~(has("value") & has("raw_value") & has("source") & has("extraction")), "found without value, source or extraction"),
        F.when(found & has("reason"), "found with a reason"),
        F.when(pending & (has("value") | has("source") | has("reason")), "pending with content"),
        F.when(~found & ~pending & (has("value") | ~has("reason")), "a value, or no reason"),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


DOMAINS = {"fund_id": "^fund_[0-9a-f]{16}$", "sha256": "^[0-9a-f]{64}$", "currency": "^[A-Z]{3}$", "ico": r"^\d{8}$"}


def in_domain(x: Column, domain: str) -> Column:
    return x.rlike(DOMAINS[domain])


def series_errors(observations: Column) -> Column:
    """A series has distinct days and one currency."""
    days, currencies = F.transform(observations, lambda o: o["as_of"]), F.array_distinct(F.transform(observations, lambda o: o["currency"]))
    return F.filter(F.array(F.when(F.size(F.array_distinct(days)) < F.size(days), "repeated days"), F.when(F.size(currencies) > 1, "several currencies")), lambda x: x.isNotNull())


def tier_errors(rate: Column, amount: Column, currency: Column, low: Column, high: Column) -> Column:
    return F.filter(F.array(F.when(rate.isNull() & amount.isNull(), "neither rate nor amount"), F.when(amount.isNotNull() & currency.isNull(), "amount without currency"), F.when(low > high, "months inverted")), lambda x: x.isNotNull())
