"""Language of web pages by fusing evidence with Bayes' rule.

log p(language | page) adds up: the likelihood of the page's main text under character trigram
models; the likelihood of the language that the markup declares; that of the address's suffix; and
a prior of the page's host, smoothed by that of its domain and of all pages. All but the text
models are estimated by grouped aggregation over all pages, from the text posteriors as soft
counts; a page's own count is taken out again before it is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from allocspark.llm.common import cut_lineage, text_or_empty
from allocspark.llm.html_extract import main_text

BUCKETS = 1 << 13
#: At most so many documents of known language are learned from: those with the smallest hash of their id.
TRAIN_ROWS = 4_000
#: At most so many languages, the most frequent of the training rows.
MAX_LANGUAGES = 200
#: Trigrams overlap and repeat: so many of a page at most count as independent.
EFFECTIVE = 60.0
#: Weight of a prior of the level above, in pages.
SMOOTHING = 4.0
NONE, OTHER = "-", "?"


def trigram_buckets(text: str) -> np.ndarray:
    points = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    mixed = points[:-2] * np.uint64(0x9E3779B97F4A7C15) + points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + points[2:] * np.uint64(0x165667B19E3779F9)
    return ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(51)).astype(np.int64)


def learn_text_models(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log p(bucket | language)); rows without an id, a language or a text aren't used."""
    known = documents.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = known.select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(train_rows)
    # Bounded by train_rows ids.
    rows = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text_or_empty(text_col).alias("text")).join(
        F.broadcast(chosen), "id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = np.bincount(trigram_buckets(text), minlength=BUCKETS)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            places = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int64()),
                                              pa.array(found[places], pa.int64())], names=["lang", "bucket", "n"])

    counted = cut_lineage(rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    languages = sorted(r["lang"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang")
                       .limit(MAX_LANGUAGES).collect())
    table = np.full((len(languages), BUCKETS), 0.5)
    for row in counted.where(F.col("lang").isin(languages)).collect() if languages else []:
        table[languages.index(row["lang"]), row["bucket"]] += row["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def host_of(url: str | None) -> tuple[str, str, str]:
    """(host, domain, suffix) of an address, lower case; empty where there is none."""
    try:
        host = (urlsplit(url or "").hostname or "").lower().rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".") if host else []
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 else ""


def page_evidence(pages: DataFrame, languages: list[str], models: np.ndarray, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, host, domain, suffix, declared, n_trigrams, likelihood[languages], posterior[languages])."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text, lang = main_text(html)
                lang = (lang or "").strip().lower().replace("_", "-").split("-")[0]
                found = trigram_buckets(text)
                n = len(found)
                likelihood = models[:, found].sum(axis=1) * (min(n, EFFECTIVE) / n if n else 0.0)
                chances = np.exp(likelihood - likelihood.max())
                for column, value in zip(columns, (*host_of(url), lang if lang in languages else OTHER if lang else NONE,
                                                   n, likelihood, chances / chances.sum())):
                    column.append(value)
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.string()) for c in columns[:4]), pa.array(columns[4], pa.int64()),
                 pa.array(columns[5], doubles), pa.array(columns[6], doubles)],
                names=["id", "url", "host", "domain", "suffix", "declared", "n_trigrams", "likelihood", "posterior"])

    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, f"id {kind}, url string, host string, domain string, suffix string, declared string, "
                                "n_trigrams long, likelihood array<double>, posterior array<double>")


def _sums(rows: DataFrame, by: list[str], value: str, name: str, size: int) -> DataFrame:
    return rows.groupBy(*by).agg(F.array(*[F.sum(F.col(value)[i]) for i in range(size)]).alias(name))


def _minus(counts: Column, own: Column) -> Column:
    return F.zip_with(counts, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)


def _smoothed(counts: Column, above: Column) -> Column:
    """Shares by language: the counts and ``SMOOTHING`` rows of the level above."""
    total = _total(counts) + F.lit(SMOOTHING)
    return F.zip_with(counts, above, lambda n, p: (n + F.lit(SMOOTHING) * p) / total)


def identify(pages: DataFrame, languages: list[str], models: np.ndarray, id_col: str = "page_id",
             url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: the id, url, host, declared, text_lang (by the text alone), lang and confidence.

    A page without text goes by its other evidence, one without any by all pages' languages; ties go
    to the first language by name. text_lang is null without text; with no language known, lang is
    null and confidence 0. Repeated pages count as often as they stand; other columns are left out.
    """
    if not languages:
        nothing = F.lit(None).cast("string")
        return pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`").cast("string").alias("url"), nothing.alias("host"),
                            nothing.alias("declared"), nothing.alias("text_lang"), nothing.alias("lang"), F.lit(0.0).alias("confidence"))
    size = len(languages)
    names = F.array(*[F.lit(name) for name in languages])
    rows = cut_lineage(page_evidence(pages, languages, models, id_col, url_col, html_col))

    # One pass counts hosts; domains, suffixes and all pages are sums of hosts.
    with_text = rows.withColumn("own", F.transform("posterior", lambda p: F.when(F.col("n_trigrams") > 0, p).otherwise(0.0)))
    hosts = cut_lineage(_sums(with_text, ["host", "domain", "suffix"], "own", "of_host", size))
    domains = _sums(hosts, ["domain"], "of_host", "of_domain", size)
    suffixes = _sums(hosts, ["suffix"], "of_host", "of_suffix", size)
    everything = hosts.agg(F.array(*[F.coalesce(F.sum(F.col("of_host")[i]), F.lit(0.0)) for i in range(size)]).alias("t")).first()["t"]
    # At most one row for each language, and for none and other: bounded by MAX_LANGUAGES + 2.
    declared = F.broadcast(_sums(with_text, ["declared"], "own", "of_declared", size))
    overall = F.array(*[F.lit((n + 1.0) / (sum(everything) + size)) for n in everything])
    totals = F.array(*[F.lit(float(n)) for n in everything])

    table = hosts.join(domains, "domain").join(suffixes, "suffix").select("host", "of_host", "of_domain", "of_suffix")
    joined = with_text.join(table, "host").join(declared, "declared")
    domain_prior = _smoothed(_minus(F.col("of_domain"), F.col("own")), overall)
    host_prior = _smoothed(_minus(F.col("of_host"), F.col("own")), domain_prior)

    def likelihood(counts: str) -> Column:
        """p(this declaration or suffix | language), smoothed towards its share of all pages."""
        own = _minus(F.col(counts), F.col("own"))
        share = (_total(own) + 1.0) / (_total(totals) + size)
        return F.zip_with(own, _minus(totals, F.col("own")), lambda n, t: (n + F.lit(SMOOTHING) * share) / (t + SMOOTHING))

    def plus(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + F.log(y))

    scores = plus(plus(plus(F.col("likelihood"), likelihood("of_declared")), likelihood("of_suffix")), host_prior)
    scored = joined.withColumn("scores", scores).withColumn("best", F.array_max("scores"))
    confidence = F.lit(1.0) / _total(F.transform("scores", lambda s: F.exp(s - F.col("best"))))
    text_lang = F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int"))
    return scored.select(
        F.col("id").alias(id_col), "url", "host", "declared",
        F.when(F.col("n_trigrams") > 0, text_lang).alias("text_lang"),
        F.element_at(names, F.array_position("scores", F.col("best")).cast("int")).alias("lang"), confidence.alias("confidence"))
