"""Filter interaction audit by inclusion-exclusion.

Five filters fail documents; any order of them removes the same documents, but which filter removes how many depends on
the order. For each part the joint-failure counts of all 32 sets of filters are aggregated once, as sums of products of
flags. Everything else is arithmetic on them: the Möbius inversion gives how many documents any set of filters removes, and
with that the survivors after each step of each of the 120 orders, what is removed there and what was removed before; the
counts' Harsanyi dividends, shared equally by their sets, give the Shapley values.

Filter E fails every row whose text a smaller doc_id has. Its flag is carried as a difference: E's failures are all rows
less the first ones of each text, so a sum with E in its set takes all rows and takes the first ones off again. First rows
come from a rank that each task cuts before it sends anything, so a text that a third of all rows share meets nowhere.
Texts are compared by their SHA-256.

Edge cases: a null text is empty, a null source is part ''. A row without doc_id is never E and makes no other E. Rows of
one doc_id and one text are all first, or all E. A doc_id's labels are 1 if any of its label rows says so. An empty table
gives no rows. Columns beyond the named ones aren't read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, plain, table

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS = 200
#: Sets of filters as bit masks: bit i is filter i.
SETS = range(1 << len(FILTERS))
#: What is counted in each set: rows, rows of good quality, toxic rows.
WEIGHTS = ("one", "good", "toxic")


def judged(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, source) to (doc_id, part, digest, A, B, C, D), the flags 0 or 1: what one text alone decides."""
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    tests = {"A": n < LEAST_WORDS, "B": 100 * distinct.cast("long") < 50 * n.cast("long"), "C": 100 * capitals.cast("long") > 2 * F.length("text").cast("long"), "D": F.col("text").rlike(r"[#$%&*|]")}
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *(t.cast("int").alias(f) for f, t in tests.items()))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic, 0 or 1, by labels(doc_id, quality, toxic)."""
    is_one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    return rows.join(known, "doc_id", "left").fillna(0, ["good", "toxic"]).withColumn("one", F.lit(1))


def firsts(rows: DataFrame) -> DataFrame:
    """The rows whose text no smaller doc_id has."""
    ranked = rows.where("doc_id is not null").withColumn("_place", F.rank().over(W.partitionBy("digest").orderBy("doc_id")))
    return ranked.where("_place = 1").drop("_place").unionByName(rows.where("doc_id is null"))


def _members(mask: int) -> str:
    return "".join(f for i, f in enumerate(FILTERS) if mask >> i & 1)


def joint_failures(rows: DataFrame) -> DataFrame:
    """(part, one, good, toxic): for each weight an array of 32 sums, that of the rows that fail all filters of the set."""
    # all rows: 1 for sets without E, 1 for E; first rows: nothing for sets without E, E's 1 taken off again
    signed = rows.withColumns({"base": F.lit(1), "E": F.lit(1)}).unionByName(firsts(rows).withColumns({"base": F.lit(0), "E": F.lit(-1)}))

    def product(mask: int, weight: str) -> Column:
        names = _members(mask)
        flags = [F.col(weight), *map(F.col, names), *([] if "E" in names else [F.col("base")])]
        return reduce(lambda a, b: a * b, flags)

    sums = signed.groupBy("part").agg(*(F.sum(product(m, w)).cast("long").alias(f"{w}{m}") for w in WEIGHTS for m in SETS))
    return sums.select("part", *(F.array(*(F.col(f"{w}{m}") for m in SETS)).alias(w) for w in WEIGHTS))


def _signed(weight: str, sets: list[int], flip: int = 1) -> Column:
    """The sum of a weight's joint failures over sets, an odd one added and an even one taken off."""
    return reduce(lambda a, b: a + b, (F.get(F.col(weight), F.lit(m)) * (1 if m.bit_count() % 2 else -1) * flip for m in sets), F.lit(0).cast("long"))


def audit(joint: DataFrame) -> DataFrame:
    """joint_failures() to a row for each part, order of filters and step."""
    within = lambda s: [m for m in SETS if m and m & s == m]
    holding = lambda i: [m for m in SETS if m >> i & 1]
    # Möbius inversion: what each set of filters removes, by weight.
    lost = {f"{w}_lost": F.array(*(_signed(w, within(s)) for s in SETS)) for w in WEIGHTS}
    dividend = lambda i: reduce(lambda a, b: a + b, (_signed("one", [m]) * (len(ORDERS) // m.bit_count()) for m in holding(i)))
    parts = joint.select(
        "part",
        F.get("one", F.lit(0)).alias("total"),
        F.array(*(F.get("one", F.lit(1 << i)) for i in range(len(FILTERS)))).alias("failing"),
        F.array(*(_signed("one", holding(i)) for i in range(len(FILTERS)))).alias("unique"),
        F.array(*(dividend(i) for i in range(len(FILTERS)))).alias("shares"),
        *(c.alias(n) for n, c in lost.items()),
    )
    steps = parts.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = lambda k: F.instr(F.lit(FILTERS), F.substring(F.col("filter_order"), k, F.lit(1))) - 1
    bits = F.transform(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda k: F.when(k < F.col("step"), F.call_function("shiftleft", F.lit(1), place(k))).otherwise(0))
    steps = steps.withColumns({"i": place(F.col("step")), "before": F.aggregate(bits, F.lit(0), lambda a, x: a + x)})
    steps = steps.withColumn("after", F.col("before") + F.call_function("shiftleft", F.lit(1), F.col("i")))
    gone = lambda w: F.get(f"{w}_lost", F.col("after")) - F.get(f"{w}_lost", F.col("before"))
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("total") - F.get("one_lost", F.col("after"))).alias("kept"),
        gone("one").alias("removed"),
        (F.get("failing", F.col("i")) - gone("one")).alias("redundant"),
        F.get("unique", F.col("i")).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.get("shares", F.col("i")).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    docs = plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", source="source")
    labels = plain(table(spark, sf_dir, "labels"), doc_id="doc_id", quality="quality", toxic="toxic")
    rows = scratch.save(labelled(judged(docs), labels), "judged")
    joint = scratch.save(joint_failures(rows), "joint")  # one row a part
    scratch.drop(rows)
    return audit(joint)


#: The same in DuckDB SQL: every order is gone through step by step, without inclusion and exclusion.
ORACLE = r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > first_id, FALSE)] AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), g AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c, c d, c e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, [instr('ABCDE', x) FOR x IN string_split(filter_order, '')] AS places FROM o, unnest(range(1, 6)) AS u(step)),
r AS (
  SELECT part, filter_order, step, places[step] AS own, n, good, toxic, fails[places[step]] AS hit,
         len([x FOR x IN places[1:step - 1] IF fails[x]]) > 0 AS gone, len([x FOR x IN fails IF x]) AS n_fails
  FROM g, s
), p AS (
  SELECT part, filter_order, step, own, CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE gone AND hit), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (WHERE hit AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND hit AND good = 1), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND hit AND toxic = 1), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM p
"""
