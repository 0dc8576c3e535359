"""All fields of each customer's fund in one program, from a document for each of its orders.

The documents word what the tables say in several ways, over line ends too, deny it, contradict each other, are worth
more or less by their type, and partly speak of another fund.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import program
from ..plans.extraction import PRIORITIES
from ..queries import query, table

TYPES = {"1-URGENT": "statute", "2-HIGH": "memorandum", "3-MEDIUM": "priips_kid", "4-NOT SPECIFIED": "factsheet", "5-LOW": "marketing_page"}
NEWEST = 2026


def order_documents(spark, d):
    """(fund, fund_name, source_id, document_type, page, title, text)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    pick = lambda n, *texts: F.element_at(F.array(*texts), (k % n + 1).cast("int"))
    text = F.lit
    years = s((c + k) % 3 + 2)
    horizon = F.when(k % 7 == 0, text("Horizont investice není stanoven")).otherwise(pick(3, F.concat(text("Doporučený investiční horizont je "), years, text(" let")), F.concat(text("Investiční\nhorizont činí "), years, text(" roky")), F.concat(text("Recommended holding period: "), years, text(" years"))))
    minimum = F.when(k % 6 == 0, text("Minimální investice, cena investiční akcie 1 000 Kč")).when(k % 6 == 1, text("Initial subscription 125 000 EUR")).otherwise(F.concat(text("Minimální investice: "), s(1 + k % 2), text(" mil. Kč")))
    target = pick(4, F.concat(text("Cílový výnos "), s(3 + c % 4), text(",5 % p.a.")), text("Očekávaný výnos 4 až 6 % ročně"), text("Minulá výkonnost, cílový výnos 9 %"), text("Fond nezveřejňuje cílový výnos"))
    fee = F.concat(text("Vstupní poplatek max. "), s(1 + c % 2 + F.when(k % 3 == 0, 1).otherwise(0)), text(" %"))
    capital = F.concat(text("Fondový kapitál k 31. 12. "), s(2010 + k % 12), text(": "), s(100 + k % 700), text(" mil. Kč"))
    filler = text("Ostatní ustanovení tohoto dokumentu\nplatí beze změny dále\npro všechny investory stejně")
    other = F.when(k % 4 == 0, F.concat(text("\nBeta SICAV\n"), filler, text("\nInvestiční horizont 99 let"))).otherwise(text(""))
    body = F.concat(F.concat_ws("\n", F.concat(text("Alfa"), s(c), text(" SICAV")), filler, horizon, filler, minimum, filler, target, filler, fee, filler, capital, filler), other)
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), F.trim("o_orderpriority"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")  # narrow rows, before they become text
    return orders.select(c.alias("fund"), F.concat(text("Alfa"), s(c), text(" SICAV")).alias("fund_name"), k.alias("source_id"), kind.alias("document_type"), F.lit(1).alias("page"), F.lit("").alias("title"), body.alias("text"))


def program_of(spark, d):
    return program.all_fields(order_documents(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("fund")), NEWEST)


def _worth(field: str) -> str:
    own = PRIORITIES[field]
    return "CASE kind " + " ".join(f"WHEN '{t}' THEN {own[t]}" for t in TYPES.values() if t in own) + " ELSE 10 END"


KINDS = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in TYPES.items())
NUL = "NULL::DOUBLE"
SETTLED = f"""o AS (SELECT o_custkey AS fund, o_orderkey AS k, CASE trim(o_orderpriority) {KINDS} END AS kind FROM orders),
c AS (SELECT fund, k, 'investment_horizon' AS field, '' AS point, (fund + k) % 3 + 2.0 AS low, {NUL} AS high, 'exact' AS word, {_worth('investment_horizon')} AS p, CASE WHEN k % 3 = 0 THEN 85 ELSE 70 END AS bonus FROM o WHERE k % 7 <> 0
UNION ALL SELECT fund, k, 'minimum_investment', 'initial_subscription|', CASE WHEN k % 6 = 1 THEN 125000 ELSE (1 + k % 2) * 1e6 END, {NUL}, CASE WHEN k % 6 = 1 THEN 'EUR' ELSE 'CZK' END, {_worth('minimum_investment')}, 70 FROM o WHERE k % 6 <> 0
UNION ALL SELECT fund, k, 'target_return', CASE WHEN k % 4 = 0 THEN 'target|' ELSE 'expected|' END, CASE WHEN k % 4 = 0 THEN 3.5 + fund % 4 ELSE 4 END, CASE WHEN k % 4 = 1 THEN 6.0 END, 'per_annum', {_worth('target_return')}, CASE WHEN k % 4 = 0 THEN 80 ELSE 90 END FROM o WHERE k % 4 <= 1
UNION ALL SELECT fund, k, 'fees', 'entry', 1 + fund % 2 + (k % 3 = 0)::INT, {NUL}, NULL, {_worth('fees')}, 60 FROM o
UNION ALL SELECT fund, k, 'assets_under_management', 'fund_capital|CZK|' || (2010 + k % 12) || '-12-31', (100 + k % 700) * 1e6, {NUL}, 'CZK', {_worth('assets_under_management')}, 60 + greatest(0, least(50, 50 - 10 * ({NEWEST} - (2010 + k % 12)))) FROM o
UNION ALL SELECT fund, k, 'aum_history', 'fund_capital|CZK|' || (2010 + k % 12) || '-12-31', (100 + k % 700) * 1e6, {NUL}, 'CZK', {_worth('assets_under_management')}, 0 FROM o
UNION ALL SELECT fund, k, 'historical_values', 'fund_capital||CZK|' || (2010 + k % 12) || '-12-31', (100 + k % 700) * 1e6, {NUL}, 'CZK', {_worth('assets_under_management')}, 0 FROM o),
lead AS (SELECT fund, field, arg_max(point, (p + bonus, k)) AS point FROM c WHERE field IN ({', '.join(f"'{f}'" for f in program.SINGLE)}) GROUP BY fund, field),
r AS (SELECT * FROM c WHERE field NOT IN ({', '.join(f"'{f}'" for f in program.SINGLE)}) UNION ALL SELECT c.* FROM c JOIN lead USING (fund, field, point)),
v AS (SELECT fund, field, point, low, high, word, max(p) AS p, arg_max(k, (p, p + bonus, -k)) AS source_id FROM r GROUP BY fund, field, point, low, high, word),
t AS (SELECT *, count(*) OVER w AS n, max(p) OVER w AS top FROM v WINDOW w AS (PARTITION BY fund, field, point)),
z AS (SELECT *, count(*) FILTER (WHERE p = top) OVER (PARTITION BY fund, field, point) AS tops FROM t),
s AS (SELECT fund, field, point, low, high, word, CASE WHEN n = 1 THEN 'equivalent_after_normalization' ELSE 'auto_resolved' END AS outcome, CASE WHEN n > 1 THEN 'document_type' END AS decided_by, n AS n_values, source_id FROM z WHERE p = top AND tops = 1
UNION ALL SELECT DISTINCT fund, field, point, {NUL}, {NUL}, NULL, 'unresolved', NULL, n, NULL FROM z WHERE tops > 1)"""


@query("program_values", f"WITH {SETTLED} SELECT * FROM s")
def program_values(spark, d):
    return program_of(spark, d)[1].select("fund", "field", "point", "low", "high", "word", "outcome", "decided_by", "n_values", "source_id")


@query("program_states", f"""WITH {SETTLED}, g AS (SELECT c_custkey AS fund, unnest([{', '.join(f"'{f}'" for f in program.FIELDS)}]) AS field FROM customer),
n AS (SELECT fund, field, count(*) FILTER (WHERE outcome <> 'unresolved') AS n_points, count(*) FILTER (WHERE outcome = 'unresolved') AS n_unresolved FROM s GROUP BY fund, field),
told AS (SELECT DISTINCT fund, 'target_return' AS field FROM o WHERE k % 4 = 3), refused AS (SELECT DISTINCT fund, 'investment_horizon' AS field FROM o WHERE k % 4 = 0)
SELECT g.fund, g.field, CASE WHEN coalesce(n_points, 0) > 0 THEN 'found' WHEN coalesce(n_unresolved, 0) > 0 THEN 'conflicting' WHEN (g.fund, g.field) IN (SELECT (fund, field) FROM refused) THEN 'scope_unconfirmed' WHEN (g.fund, g.field) IN (SELECT (fund, field) FROM told) THEN 'not_publicly_disclosed' ELSE 'not_found' END AS status,
coalesce(n_points, 0) AS n_points, coalesce(n_unresolved, 0) AS n_unresolved FROM g LEFT JOIN n USING (fund, field)""")
def program_states(spark, d):
    return program_of(spark, d)[0].select("fund", "field", "status", "n_points", "n_unresolved")
