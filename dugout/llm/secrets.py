"""Secret scans with DataFrame functions alone.

Base patterns give the kinds assign, access and hex. The method adds the kind entropy: candidate strings (runs of 20 and
more letters, digits and base64 signs) are split by character class into hexadecimal and mixed ones. A window of WINDOW
characters slides over each; the count of the entering character goes up, that of the leaving one down, and the sum of
c * log2(c) changes by those two terms, from which the window's Shannon entropy follows. Windows that reach their
class's threshold join into spans. The allow list has two parts. What says something about a whole candidate (words and
identifiers without digits, numbers, UUIDs, paths of words, integrity hashes) leaves it alone; what stands inside one
(alphabets in order, placeholders) only clears the windows that it touches: the candidate is cut there.

Positions of all matches come from the lengths of the matches and of the gaps between them, so everything is one narrow
projection over the scan: no shuffle, and nothing that depends on other rows. Time is linear in the text and its matches.

Edge cases: a null or empty text has no spans (counts 0, the digest of the empty string). Every input row gives one row,
repeated ones too; a null id stays null. Whole texts are read, however long. Columns beyond the named ones aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PART, located, plain, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
HEX_SIGNS = "0123456789abcdef"
MIXED_SIGNS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Bits a character. A window of 20 can reach 4.32; random hexadecimal has about 3.4 and random base64 about 4.1.
HEX_BITS, MIXED_BITS = 3.05, 3.85

#: Whole candidates that look random but are known to be harmless.
ALLOWED = (
    r"^[^0-9]*$",  # words and identifiers without digits
    r"^[0-9]+$",  # numbers
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",  # UUIDs
    r"^(sha256|sha384|sha512)-",  # integrity hashes of public files
    r"^/?([A-Z]?[a-z_-]+/)+[A-Z]?[a-z_-]*[0-9]{0,6}$",  # paths of words
)
#: Parts of candidates that are known to be harmless, alphabets in order and placeholders.
ALLOWED_PART = r"(?i:0123456789|abcdefghij|klmnopqrst|qwertyuiop|example|placeholder|changeme|dummy|sample|x{6,})"


def _located(matches: Column, gaps: Column) -> Column:
    """array<struct<start, end, value>> from all matches and the gaps before, between and after them."""
    zipped = F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g"))
    return located(zipped, lambda x: F.length(x["g"]), lambda x: F.length(x["m"]), value=("string", lambda x: x["m"]))


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _windows(value: Column, signs: str, bits: float) -> Column:
    """array<struct<start, end>> of the joined windows of one candidate that reach the entropy, from 0."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(signs), c) - 1)
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    steps = F.slice(F.arrays_zip(codes.alias("enter"), leaving.alias("leave")), F.lit(1), F.length(value))
    # Spans of a candidate: the last few, and full parts, as appending to an array copies it.
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    zero = F.struct(
        F.array_repeat(F.lit(0), len(signs)).alias("counts"),
        F.lit(0.0).alias("sum"),  # of c * log2(c)
        F.lit(0).alias("seen"),
        F.lit(-1).alias("start"),  # the span that may still grow, if any
        F.lit(-1).alias("end"),
        none.alias("spans"),
        F.expr("cast(array() as array<array<struct<start:int,end:int>>>)").alias("parts"),
    )
    weight = lambda c: F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)

    def slide(acc: Column, x: Column) -> Column:
        enter, leave = x["enter"], x["leave"]
        up, down = F.get(acc["counts"], enter), F.get(acc["counts"], leave)
        changed = F.when(enter == leave, 0.0).otherwise(weight(up + 1) - weight(up) + F.when(leave >= 0, weight(down - 1) - weight(down)).otherwise(0.0))
        counts = F.when(enter == leave, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, i: c + F.when(i == enter, 1).when(i == leave, -1).otherwise(0)))
        total, seen = acc["sum"] + changed, acc["seen"] + 1
        high = (seen >= WINDOW) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= bits)
        grows = (acc["start"] >= 0) & (acc["end"] >= seen - WINDOW)
        closes = high & (acc["start"] >= 0) & ~grows
        full = closes & (F.size(acc["spans"]) >= PART)
        closed = F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            seen.alias("seen"),
            F.when(high & ~grows, seen - WINDOW).otherwise(acc["start"]).alias("start"),
            F.when(high, seen).otherwise(acc["end"]).alias("end"),
            F.when(full, closed).when(closes, F.concat(acc["spans"], closed)).otherwise(acc["spans"]).alias("spans"),
            F.when(full, F.concat(acc["parts"], F.array(acc["spans"]))).otherwise(acc["parts"]).alias("parts"),
        )

    last = lambda acc: F.when(acc["start"] >= 0, F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))).otherwise(none)
    return F.aggregate(steps, zero, slide, lambda acc: F.concat(F.flatten(acc["parts"]), acc["spans"], last(acc)))


def _pieces(candidate: Column) -> Column:
    """array<struct<start, value, is_hex>> of what is left of a candidate beside its harmless parts."""
    value, is_hex = candidate["value"], candidate["value"].rlike("^[0-9A-Fa-f]+$")
    piece = lambda start, text: F.struct(start.cast("int").alias("start"), text.alias("value"), is_hex.alias("is_hex"))
    gaps = F.split(value, ALLOWED_PART, -1)
    ends = F.concat(F.array(F.lit(0)), F.transform(_located(_all(value, ALLOWED_PART), gaps), lambda x: x["end"]))
    cut = F.transform(F.arrays_zip(ends.alias("at"), gaps.alias("text")), lambda x: piece(candidate["start"] + x["at"], x["text"]))
    return F.when(value.rlike(ALLOWED_PART), cut).otherwise(F.array(piece(candidate["start"], value)))


def find_secrets(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) with found: array<struct<start int, kind int, end int>>, in order of start and kind.

    Kinds are positions in KINDS; positions in the text are code points, the end exclusive.
    """
    text = F.col("text")
    found = docs.withColumn("text", F.coalesce("text", F.lit("")))
    found = found.withColumns({
        "m_assign": _all(text, ASSIGN),
        "m_access": F.when(F.contains(text, F.lit("AKIA")), _all(text, ACCESS)).otherwise(F.expr("cast(array() as array<string>)")),
        "m_hex": _all(text, HEX),
        "m_high": _all(text, CANDIDATE),
    })
    gaps = lambda pattern: F.split(text, pattern, -1)
    found = found.withColumns({
        "s_assign": _located(F.col("m_assign"), gaps(ASSIGN)),
        "v_assign": F.when(F.size("m_assign") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))),
        "s_access": _located(F.col("m_access"), gaps(ACCESS)),
        "s_hex": _located(F.col("m_hex"), gaps(HEX)),
        "s_high": F.filter(_located(F.col("m_high"), gaps(CANDIDATE)), lambda x: ~_allowed(x["value"])),
    })
    span = lambda x, kind: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))
    passed = F.filter(F.arrays_zip("s_assign", "v_assign"), lambda x: F.length(x["v_assign"]) >= ASSIGN_LEAST)
    high = F.flatten(
        F.transform(
            F.flatten(F.transform("s_high", _pieces)),
            lambda x: F.transform(
                F.when(x["is_hex"], _windows(F.lower(x["value"]), HEX_SIGNS, HEX_BITS)).otherwise(_windows(x["value"], MIXED_SIGNS, MIXED_BITS)),
                lambda w: F.struct((x["start"] + w["start"]).alias("start"), F.lit(3).alias("kind"), (x["start"] + w["end"]).alias("end")),
            ),
        )
    )
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    spans = F.concat(
        F.when(F.size("m_assign") > 0, F.transform(passed, lambda x: span(x["s_assign"], 0))).otherwise(none),
        F.transform(F.col("s_access"), lambda x: span(x, 1)),
        F.transform(F.col("s_hex"), lambda x: span(x, 2)),
        high,
    )
    return found.select("doc_id", "text", F.sort_array(spans).alias("found"))


def _allowed(value: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | value.rlike(pattern)
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["kind"] < 3)
    return found.select("doc_id", *(count(i).alias(f"n_{KINDS[i]}") for i in range(3)), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def _oracle() -> str:
    """The same in DuckDB SQL, window by window instead of by incremental counts."""
    q = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = ((0, ASSIGN, 2), (1, ACCESS, 0), (2, HEX, 0), (4, CANDIDATE, 0))
    found = " UNION ALL ".join(f"SELECT doc_id, {k} AS kind, regexp_extract_all(t, {q(p)}, 0) AS m, regexp_extract_all(t, {q(p)}, {g}) AS v, string_split_regex(t, {q(p)}) AS g FROM d" for k, p, g in kinds)
    allowed = " OR ".join(f"regexp_matches(val, {q(p)})" for p in ALLOWED)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
s AS (
  SELECT doc_id, kind, m[i] AS val, v[i] AS v, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM m, unnest(range(1, len(m) + 1)) AS u(i)
), k AS (
  SELECT doc_id, start, regexp_full_match(val, '[0-9A-Fa-f]+') AS is_hex, regexp_extract_all(val, {q(ALLOWED_PART)}) AS m, string_split_regex(val, {q(ALLOWED_PART)}) AS g FROM s WHERE kind = 4 AND NOT ({allowed})
), c AS (
  SELECT doc_id, start + coalesce(list_sum(list_transform(g[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start, g[i] AS val, is_hex FROM k, unnest(range(1, len(g) + 1)) AS u(i)
), w AS (
  SELECT doc_id, start, j, is_hex, unnest(string_split(substr(CASE WHEN is_hex THEN lower(val) ELSE val END, j, {WINDOW}), '')) AS sign FROM c, unnest(range(1, length(val) - {WINDOW} + 2)) AS u(j)
), n AS (SELECT doc_id, start, j, is_hex, sign, count(*) AS n FROM w GROUP BY ALL
), h AS (
  SELECT doc_id, start, j FROM n GROUP BY doc_id, start, j, is_hex HAVING log2({WINDOW}) - sum(n * log2(n)) / {WINDOW} >= CASE WHEN is_hex THEN {HEX_BITS} ELSE {MIXED_BITS} END
), f AS (SELECT *, CASE WHEN j - lag(j) OVER (PARTITION BY doc_id, start ORDER BY j) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM h
), r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY j) AS run FROM f
), spans AS (
  SELECT doc_id, 3 AS kind, start + min(j) - 1 AS a, start + max(j) - 1 + {WINDOW} AS z FROM r GROUP BY doc_id, start, run
  UNION ALL SELECT doc_id, kind, start, start + length(val) FROM s WHERE kind IN (1, 2) OR kind = 0 AND length(v) >= {ASSIGN_LEAST}
), t AS (SELECT doc_id, kind, a, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || CAST(a AS BIGINT) || ':' || CAST(z AS BIGINT) AS word FROM spans
), o AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(word, ',' ORDER BY a, kind) FILTER (WHERE kind < 3) AS base, string_agg(word, ',' ORDER BY a, kind) AS spans FROM t GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o ON d.doc_id = o.doc_id
"""


ORACLE = _oracle()
