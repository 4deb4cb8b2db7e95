"""Language identification by Bayesian evidence fusion.

For a row, log P(language | evidence) adds up, but for a constant,
 * the text's likelihood: byte trigrams of its letters under one multinomial model a language, and under an even one
   for "und" (no known language); trigrams overlap and depend on each other, so the sum is tempered;
 * the declared markup language: right but for a share DECLARED_WRONG;
 * the address suffix: countries point to their languages, general suffixes to none;
 * the host's prior, smoothed up its hierarchy: counts of a host's rows by language, plus STRENGTH rows of the domain's
   prior, which has as many of the suffix's, which has as many of the whole table's. The counts come from a grouped
   aggregation over all rows, of the languages that text and declaration favour; a row's own count is taken out of them
   before they judge it.
A well-formed declaration of a language without a model is a candidate of its own beside the modelled ones: its text is
as likely as under the even model, so it stands where no model fits better. Rows whose best language is "und" or less probable than LEAST are rejected.

The models are fitted on a bounded sample: about `sample` rows a language, those with the least hashes of their ids.
Everything else covers all rows.

Edge cases: a null or empty text, or one without letters, has no text evidence; the declaration, suffix and host then
decide, and without any of those the language is "und" and the row is rejected. Nulls and unknown tags in any evidence
column are neutral. Rows that repeat return as often, with equal results. An empty table gives an empty result.
Columns beyond the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, plain, slices, table

#: Rows of each language that the models are fitted on, the least a language needs for a model, and the most languages
#: with one, those with the most rows.
SAMPLE, FEWEST, MOST_LANGUAGES = 400, 5, 64
BUCKETS = 1 << 14
#: A trigram's weight in the likelihood, and the most trigrams' worth of evidence a text has.
WEIGHT, MOST = 1 / 3, 200.0
DECLARED_WRONG, SUFFIX_WRONG = 0.1, 0.25
STRENGTH, UND_PRIOR, LEAST = 20.0, 0.02, 0.5
UND = "und"
#: The place of a declared language that has no model, and its log likelihood where none is declared.
OTHER, NEVER = "other", -1e6
#: Country suffixes and their main languages.
SUFFIX_LANGUAGES = {
    "at": "de", "au": "en", "ar": "es", "br": "pt", "ca": "en", "cl": "es", "cn": "zh", "co": "es", "de": "de", "es": "es", "fr": "fr", "gb": "en", "ie": "en",
    "it": "it", "jp": "ja", "mx": "es", "nl": "nl", "nz": "en", "pe": "es", "pl": "pl", "pt": "pt", "ru": "ru", "se": "sv", "uk": "en", "us": "en",
}


_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all trigrams with at most one blank, and the text each is in."""
    folded = _FOLD[np.frombuffer(b"  ".join([b"", *texts, b""]), dtype=np.uint8)]
    blank = folded == 0x20
    a, b, c = folded[:-2].astype(np.uint32), folded[1:-1].astype(np.uint32), folded[2:].astype(np.uint32)
    # Words with a blank on either side; a lone blank between words starts the next one.
    kept = np.flatnonzero(~blank[1:-1] & ~(blank[:-2] & blank[2:]))
    code = (a[kept] << np.uint32(16)) | (b[kept] << np.uint32(8)) | c[kept]
    bucket = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(50)).astype(np.int64)
    ends = np.cumsum([len(t) + 2 for t in texts]) + 2
    return bucket, np.searchsorted(ends, kept + 1, side="right")


class TextModels:
    """Log probabilities of trigram buckets: a row for each language, the last for "und"."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        even = np.full((1, BUCKETS), np.log(1 / BUCKETS))
        self.logs = np.concatenate([np.log(smooth / smooth.sum(axis=1, keepdims=True)), even]).astype(np.float32)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log likelihoods (texts, languages + 1), and the number of trigrams."""
        bucket, text = _trigrams(texts)
        n = np.bincount(text, minlength=len(texts))[: len(texts)]
        sums = np.stack([np.bincount(text, weights=row[bucket], minlength=len(texts))[: len(texts)] for row in self.logs], axis=1)
        weight = WEIGHT * np.minimum(1, MOST / np.maximum(n, 1))
        return sums * weight[:, None], n


def tag(declared: Column) -> Column:
    """The primary part of a language tag, null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(declared)), "^([a-z]{2,3})([-_].*)?$", 1), F.lit(""))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> TextModels:
    """Models of the languages in labelled(id, text, language). The counts that come to the driver are BUCKETS a language."""
    rows = labelled.select("id", "text", tag(F.col("language")).alias("language")).where("language is not null and language <> 'und'")
    known = rows.groupBy("language").agg(F.count("*").alias("n")).where(F.col("n") >= FEWEST).orderBy(F.desc("n"), "language").limit(MOST_LANGUAGES)
    sizes = dict(sorted((r["language"], r["n"]) for r in known.collect()))
    languages = list(sizes)
    if not languages:
        return TextModels([], np.zeros((0, BUCKETS)))
    # The share of a language's rows whose hash is low enough, about `sample` of them.
    limits = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))))
    chosen = rows.where((F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 30)) / float(1 << 30) < F.try_element_at(limits, F.col("language"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        place = {k: i for i, k in enumerate(languages)}
        for batch in batches:
            own = np.array([place[x] for x in batch.column("language").to_pylist()], dtype=np.int64)
            for a, z, texts in slices(batch):
                bucket, text = _trigrams(texts)
                np.add.at(total, (own[a:z][text], bucket), 1)
        at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[at, bucket], pa.int64())], names=["language", "bucket", "n"])

    counts = np.zeros((len(languages), BUCKETS))
    for r in chosen.select("text", "language").mapInArrow(count, "language long, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["language"], r["bucket"]] = r["n"]
    return TextModels(languages, counts)


def identify(rows: DataFrame, models: TextModels, keys: list[str]) -> DataFrame:
    """(*keys, language, probability, text_language, n_trigrams, kept) of rows(*keys, text, declared, suffix, domain, host)."""
    names = [*models.languages, OTHER, UND]
    k = len(names)
    declared, suffix = tag(F.col("declared")), F.lower("suffix")
    by_suffix = F.try_element_at(F.create_map(*(F.lit(x) for pair in SUFFIX_LANGUAGES.items() for x in pair)), suffix)
    modelled = F.coalesce(declared.isin(*models.languages), F.lit(False)) if models.languages else F.lit(False)
    # The declared language without a model, if there is one.
    other = F.when(declared.isNotNull() & (declared != UND) & ~modelled, declared)
    hint = F.when(other.isNotNull(), F.lit(OTHER)).when(modelled, declared)

    def favour(hint: Column, wrong: float) -> list[Column]:
        """Log likelihoods of a hint, 0 for all languages if it names none of them."""
        return [F.when(F.coalesce(hint.isin(*names[:-1]), F.lit(False)), F.when(hint == x, float(np.log(1 - wrong))).otherwise(float(np.log(wrong / (k - 1))))).otherwise(0.0) for x in names]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, texts in slices(batch):
                sums, n = models.score(texts)
                # A language without a model is as likely as the even model says, where it is declared at all.
                there = np.array([x is not None for x in batch.column("other").slice(a, z - a).to_pylist()], dtype=bool)
                sums = np.concatenate([sums[:, :-1], np.where(there, sums[:, -1], NEVER)[:, None], sums[:, -1:]], axis=1)
                rest = [x for x in batch.schema.names if x != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(a, z - a) for x in rest), pa.array(list(sums), pa.list_(pa.float64())), pa.array(n, pa.int64())], names=[*rest, "text_logs", "n_trigrams"])

    held = rows.select(*keys, "text", F.coalesce("suffix", F.lit("")).alias("suffix"), F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("host", F.lit("")).alias("host"), other.alias("other"), F.array(*favour(hint, DECLARED_WRONG)).alias("declared_logs"), F.array(*favour(by_suffix, SUFFIX_WRONG)).alias("suffix_logs"))
    types = dict(held.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in held.columns if c != "text"), "text_logs array<double>, n_trigrams long"])
    scored = Scratch(rows.sparkSession, "language_id").save(held.mapInArrow(score, schema), "scored")
    start = [float(np.log((1 - UND_PRIOR) / (k - 1)))] * (k - 1) + [float(np.log(UND_PRIOR))]
    add = lambda *logs: F.transform(F.arrays_zip(*(x.alias(f"x{i}") for i, x in enumerate(logs))), lambda v: sum((v[f"x{i}"] for i in range(1, len(logs))), v["x0"]))
    at = lambda logs: (F.array_position(logs, F.array_max(logs)) - 1).cast("int")
    first = add(F.col("text_logs"), F.col("declared_logs"), F.array(*map(F.lit, start)))
    scored = scored.withColumn("first", at(first))

    # Counts by language up the hierarchy; rows without any evidence say nothing of their host.
    sure = (F.col("n_trigrams") > 0) | (F.element_at("declared_logs", 1) != 0.0)
    counts = [F.count_if(sure & (F.col("first") == i)) for i in range(k)]
    hosts = scored.groupBy("suffix", "domain", "host").agg(F.array(*counts).alias("n"))
    gather = lambda df, *by: df.groupBy(*by).agg(F.array(*(F.sum(F.col("n")[i]) for i in range(k))).alias("n"))
    domains = gather(hosts, "suffix", "domain")
    suffixes = gather(domains, "suffix")
    total = gather(suffixes.withColumn("all", F.lit(0)), "all").drop("all")

    def smoothed(level: int, above: Column) -> Column:
        """Shares of a level's counts without the row's own one, and of STRENGTH rows more that are as those above."""
        size = F.col(f"size{level}") - F.when(F.col("own") >= 0, 1).otherwise(0) + STRENGTH
        counts = F.transform(F.col(f"n{level}"), lambda x, i: x - F.when(i == F.col("own"), 1).otherwise(0))
        return F.zip_with(counts, above, lambda x, p: (x + STRENGTH * p) / size)

    def level(df: DataFrame, number: int) -> DataFrame:
        return df.withColumn(f"size{number}", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).withColumnRenamed("n", f"n{number}")

    even = F.array(*(F.lit(float(np.exp(x))) for x in start))
    # The whole table's counts are one row.
    levels = level(suffixes, 1).withColumn("one", F.lit(1)).join(F.broadcast(level(total, 0).withColumn("one", F.lit(1))), "one").drop("one")
    levels = level(domains, 2).join(levels, "suffix")
    levels = level(hosts, 3).join(levels, ["suffix", "domain"])
    fused = scored.withColumn("own", F.when(sure, F.col("first")).otherwise(-1)).join(levels, ["suffix", "domain", "host"])
    prior = even
    for number in range(4):
        prior = smoothed(number, prior)
    fused = fused.withColumn("prior", prior)
    fused = fused.withColumn("logs", add(F.col("text_logs"), F.col("declared_logs"), F.col("suffix_logs"), F.transform("prior", lambda p: F.log(p))))
    fused = fused.withColumn("top", at(F.col("logs")))
    named = F.array(*map(F.lit, names))
    probability = 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("logs")))
    silent = (F.col("n_trigrams") == 0) & (F.element_at("declared_logs", 1) == 0.0) & (F.element_at("suffix_logs", 1) == 0.0) & (F.col("host") == "")
    named_by = lambda i: F.when(F.get(named, i) == OTHER, F.col("other")).otherwise(F.get(named, i))
    language = F.when(silent, F.lit(UND)).otherwise(F.coalesce(named_by(F.col("top")), F.lit(UND)))
    out = fused.select(*keys, language.alias("language"), F.when(silent, 0.0).otherwise(probability).alias("probability"), F.when(F.col("n_trigrams") > 0, named_by(at(F.col("text_logs")))).alias("text_language"), "n_trigrams")
    return out.withColumn("kept", (F.col("language") != UND) & (F.col("probability") >= LEAST))


def documents_evidence(docs: DataFrame) -> DataFrame:
    """documents as evidence: lang is the declaration, source the host; they have no address."""
    none = F.lit(None).cast("string")
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_key"), "text", F.col("lang").alias("declared"), none.alias("suffix"), none.alias("domain"), F.col("source").alias("host"))


def pages_evidence(pages: DataFrame) -> DataFrame:
    """pages as evidence: the html element's lang, and the parts of the address."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;?", " ")
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    return pages.select("page_id", body.alias("text"), declared.alias("declared"), F.substring_index(host, ".", -1).alias("suffix"), F.substring_index(host, ".", -2).alias("domain"), host.alias("host"))


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without the rejected rows; it needs the columns doc_id, text, lang and source.

    Without a single label there are no languages to know, and nothing is rejected.
    """
    own = plain(docs, doc_id="doc_id", text="text", lang="lang", source="source")
    models = fit(_labelled(own))
    if not models.languages:
        return docs
    judged = identify(documents_evidence(own), models, ["doc_id", "row_key"])
    gone = Scratch(docs.sparkSession, "language_id").save(judged.where("not kept").select(F.col("doc_id").alias("_d"), F.col("row_key").alias("_r")), "rejected")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_d"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_r"]), "left_anti")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang", source="source")
    return identify(documents_evidence(docs), fit(_labelled(docs)), ["doc_id", "row_key"]).drop("row_key")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on pages, which bring a markup language and an address; the models are fitted on documents."""
    docs = plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    pages = plain(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html")
    return identify(pages_evidence(pages), fit(_labelled(docs)), ["page_id"])
