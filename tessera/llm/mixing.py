"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, held at `most` times the source; what is over
goes to the other sources by weight. Within a source a document's wanted copies are in proportion to
a slowly growing power of its size, again held at `most`. The whole part of them is taken for certain;
the rest, p, is a chance: documents are ordered by Pareto's Q = (u / (1 - u)) / (p / (1 - p)), u a
fixed hash of doc_id, and taken in that order as long as they fit into the words wanted; one more
document of the source, the one of the nearest size, then fills the gap if that brings the words
nearer to the target. Sums over sources,
size classes and bins of Q are made before anything is sorted, so only the bin in which a source's
words run out (a 4096th of it, about) is put in exact order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh, row_hash, save, settled

MOST = 3
BINS = 4096
SEED = "mix-1"
#: Fixed value: words of a text.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Whole part of the binary logarithm of size, 0 for sizes below 2."""
    return F.when(size < 2, 0).otherwise(F.length(F.bin(size)) - 1).cast("int")


def class_weight(level: Column) -> Column:
    """16 times the fourth root of the size class's lowest size, rounded down."""
    return F.floor(F.lit(16.0) * F.pow(F.lit(2.0), level / F.lit(4.0))).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size). Sources by code point, null last, weigh `weights`, repeating."""
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(number - 1, F.lit(len(weights))) + 1).cast("int"))
    named = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    # sources that fill up first stand first; those before the first that doesn't are at their cap
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = named.withColumn("level", left.cast("double") / weights_left).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)  # of the first: further ones only fall
    return levelled.withColumn("share", level).select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("share") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def mix(df: DataFrame, weights: list[int], most: int = MOST, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, row_id, source, size, source_size, target, copies, taken) of every row of df.

    size is the number of words (null: 0), copies how often the mix takes the document (0 to `most`),
    taken its words. The words taken from a source differ from its target by less than one document.
    Texts without words are never taken. A null source is a source of its own. Repeated rows are
    drawn one by one; row_id is a hash of all columns of a row, so rows equal in all of them are alike and
    which of them is taken doesn't show. The same input gives the same mix, in whatever order its rows
    come. An empty table gives an empty one. One task orders the sources, a short row each.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(f"/{seed}"))), 1, 12), 16, 10).cast("double")
    u = (h + 0.5) / F.lit(float(2**48))
    rows = df.select(F.col(doc_id).alias("doc_id"), row_hash(df).alias("row_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), u.alias("u"))
    rows, _ = save(rows.withColumn("level", size_class(F.col("size"))).withColumn("row", F.monotonically_increasing_id()), "sizes")
    by_class = rows.groupBy("source", "level").agg(F.sum("size").alias("words"))
    targets = source_targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    classes = by_class.withColumn("m", class_weight(F.col("level"))).alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select("c.source", "level", "words", "m", "source_size", "target")
    # the same filling up, from the class that wants most copies down
    before = Window.partitionBy("source").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("source").orderBy(F.desc("level")).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("source")
    rate = (F.col("target") - F.coalesce(F.sum("words").over(before), F.lit(0)) * most) / F.sum(F.col("m") * F.col("words")).over(after)
    classes = classes.where("words > 0").withColumn("rate", rate).withColumn("full", F.col("rate") * F.col("m") >= most)
    classes = classes.withColumn("share", F.max(F.when(~F.col("full"), F.col("rate"))).over(whole))
    wanted = F.least(F.lit(float(most)), F.coalesce(F.col("share") * F.col("m"), F.lit(float(most))))
    classes = classes.withColumn("wanted", wanted).withColumn("sure", F.floor("wanted"))
    classes = classes.withColumn("rest", F.col("target") - F.sum(F.col("sure") * F.col("words")).over(whole)).withColumn("p", F.col("wanted") - F.col("sure"))
    plan, _ = save(classes.select("source", "level", "source_size", "target", "sure", "p", "rest"), "plan")
    q = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    drawn = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.level") == F.col("p.level")) & (F.col("size") > 0), "left")
    drawn = drawn.select("row", "doc_id", "row_id", "r.source", "size", "sure", "rest", F.when(F.col("p") > 0, q).alias("q"))
    drawn = drawn.withColumn("bin", F.floor(F.lit(float(BINS)) * (F.col("q") / (1 + F.col("q")))).cast("int"))
    bins = drawn.where("q is not null").groupBy("source", "bin").agg(F.sum("size").alias("words"), F.min("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    cuts = bins.withColumn("upto", upto).where("upto > rest").groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
    per_source, _ = save(targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left").select("t.source", "source_size", "target", "cut.bin", "cut.before"), "cuts")
    placed = drawn.alias("d").join(per_source.withColumnsRenamed({"bin": "cut", "source": "of"}), F.col("d.source").eqNullSafe(F.col("of"))).drop("of")
    out = ["row", "doc_id", "row_id", "source", "size", "source_size", "target", F.coalesce("sure", F.lit(0)).alias("sure"), "rest", "q"]
    below = F.col("q").isNotNull() & (F.col("cut").isNull() | (F.col("bin") < F.col("cut")))
    clear = placed.where("q is null or cut is null or bin <> cut").select(*out, below.alias("drawn"))
    order = Window.partitionBy("source").orderBy("q", "doc_id", "size", "row_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where("bin = cut").select(*out, (F.col("before") + F.sum("size").over(order) <= F.col("rest")).alias("drawn"))
    chosen, _ = save(clear.union(edge), "drawn")
    gaps = chosen.groupBy("source").agg((F.max("rest") - F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0))).alias("gap")).withColumnRenamed("source", "of")
    spare = chosen.where("q is not null and not drawn").join(gaps, F.col("source").eqNullSafe(F.col("of"))).where("size < 2 * gap")
    fill = spare.groupBy("of").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "q", "doc_id", "row_id", "row")).alias("best")).select("of", F.col("best.row").alias("fill"))
    done = chosen.join(fill, F.col("source").eqNullSafe(F.col("of")), "left")
    copies = (F.col("sure") + F.when(F.col("drawn") | F.col("row").eqNullSafe(F.col("fill")), 1).otherwise(0)).cast("int")
    return done.select("doc_id", "row_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))


def mixed(df: DataFrame, weights: list[int], most: int = MOST, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix: each row of df as often as `mix` takes it, with df's columns.

    Rows that share doc_id, text and source but differ elsewhere are drawn each on its own. Rows equal in
    all columns are drawn one by one too, and come out together as often as they were drawn. Null ids,
    texts and sources are values like others (a null text has no words and is never taken); extra
    columns, whatever their names, stay as they are. An empty table gives an empty one.
    """
    own, none, number, times, rows = fresh(df, "own", "id", "number", "times", "rows")
    plan = mix(df, weights, most, seed, doc_id, text, source).groupBy("doc_id", "row_id").agg(F.sum("copies").cast("int").alias(times), F.count("*").alias(rows))
    named = plan.where(F.col(times) > 0).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(none), F.col("row_id").alias(own), times, rows)
    taken, _ = save(named, "taken")
    marked = df.withColumns({none: F.coalesce(F.col(doc_id).cast("string"), F.lit("")), own: row_hash(df)})
    copy = F.explode(F.sequence(F.lit(1), F.col(times)))
    alone = marked.join(taken.where(F.col(rows) == 1), [none, own]).withColumn(number, copy).select(*df.columns)
    if taken.where(F.col(rows) > 1).isEmpty():
        return alone
    # rows equal in every column: one of them stands for all
    first = F.row_number().over(Window.partitionBy(none, own).orderBy(own))
    several = marked.join(taken.where(F.col(rows) > 1), [none, own]).withColumn(number, first).where(F.col(number) == 1)
    return alone.union(several.withColumn(number, copy).select(*df.columns))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return settled(spark, "op3", lambda: mix(docs, [1, 2, 3]).select("doc_id", "size", "source_size", "target", "taken"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || '/mix-1'), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656 AS u FROM documents),
lv AS (SELECT *, CASE WHEN size < 2 THEN 0 ELSE length(bin(size)) - 1 END AS l FROM d),
c AS (SELECT source, l, sum(size)::BIGINT AS words, floor(16 * pow(2.0::DOUBLE, l / 4.0::DOUBLE))::BIGINT AS m FROM lv GROUP BY source, l),
s AS (SELECT source, sum(words)::BIGINT AS ss FROM c GROUP BY source),
sn AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, ss * 3 AS cap FROM s),
sl AS (SELECT *, (sum(ss) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lev FROM sn
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
st AS (SELECT source, ss, least(cap::DOUBLE, coalesce(max(CASE WHEN NOT cap <= lev * w THEN lev END) OVER () * w, cap::DOUBLE)) AS target FROM sl),
cl AS (SELECT c.*, target FROM c JOIN st ON c.source IS NOT DISTINCT FROM st.source WHERE words > 0),
r AS (SELECT *, (target - coalesce(sum(words) OVER b, 0) * 3) / sum(m * words) OVER a AS rate FROM cl
  WINDOW b AS (PARTITION BY source ORDER BY l DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY source ORDER BY l DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT *, max(CASE WHEN NOT rate * m >= 3 THEN rate END) OVER (PARTITION BY source) AS share FROM r),
g AS (SELECT *, least(3::DOUBLE, coalesce(share * m, 3::DOUBLE)) AS wanted FROM f),
h AS (SELECT *, floor(wanted)::BIGINT AS sure, wanted - floor(wanted) AS p, target - sum(floor(wanted)::BIGINT * words) OVER (PARTITION BY source) AS rest FROM g),
x AS (SELECT lv.doc_id, lv.source, lv.size, coalesce(h.sure, 0) AS sure, h.rest, CASE WHEN h.p > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS q
  FROM lv LEFT JOIN h ON lv.source IS NOT DISTINCT FROM h.source AND lv.l = h.l AND lv.size > 0),
z AS (SELECT *, q IS NOT NULL AND sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) <= rest AS drawn FROM x),
gap AS (SELECT source, max(rest) - sum(CASE WHEN drawn THEN size ELSE 0 END) AS g FROM z GROUP BY source),
b AS (SELECT z.source, arg_min(doc_id, (abs(size - g), q, doc_id)) AS fill FROM z JOIN gap ON z.source IS NOT DISTINCT FROM gap.source WHERE q IS NOT NULL AND NOT drawn AND size < 2 * g GROUP BY z.source)
SELECT z.doc_id, z.size, st.ss AS source_size, st.target, ((sure + (drawn OR coalesce(z.doc_id = b.fill, false))::INT) * z.size)::BIGINT AS taken
FROM z JOIN st ON z.source IS NOT DISTINCT FROM st.source LEFT JOIN b ON z.source IS NOT DISTINCT FROM b.source"""
