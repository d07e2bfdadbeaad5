"""Data sets linked to journal articles, and their metrics.

Titles are compared by the overlap coefficient of their word sets, among records that share a
surname. Listing all pairs of a surname grows with its square, so pairs are found by an inverted
index instead, after the prefix filter known from set similarity joins: if at least
``ceil(t * n)`` of a title's n words must be shared, one of its ``n - ceil(t * n) + 1`` rarest
words is. Only these words of the shorter title are looked up, under surname and word together,
in the longer one. The filter is exact: no qualifying pair is lost. Where just the best article is
asked for, how often a pair met bounds its score, and pairs that can't beat or equal the score of
the most promising one are never verified.

Copies (same words, same surnames) are folded to one record before and unfolded after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import article_doi, overlap, strip_prefix, surname, title_tokens
from ..operators import split_join
from ..session import scratch_folder

THRESHOLD = 0.6


def _fingerprint() -> Column:
    return F.unhex(F.sha2(F.concat_ws("\n", F.concat_ws(" ", F.sort_array("tokens")),
                              F.concat_ws("|", F.sort_array("names"))), 256))


def _prepared_datasets(datasets: DataFrame) -> DataFrame:
    names = F.array_distinct(F.transform(F.coalesce("authors", F.array()), surname))
    return datasets.select(
        F.col("global_id").alias("package_doi"),
        article_doi(F.get("publications", F.lit(0))["citation"]).alias("direct_doi"),
        title_tokens(strip_prefix(F.col("name"))).alias("tokens"),
        names.alias("names"),
    )


def _prepared_articles(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.col("doi").alias("article_doi"), "article_index",
        title_tokens(F.col("title")).alias("tokens"), F.array_distinct("authors").alias("names"),
    )


def _words(titles: DataFrame) -> DataFrame:
    return titles.select("*", F.explode("tokens").alias("word")).drop("tokens")


def _entries(titles: DataFrame, frequency: DataFrame, tag: str, threshold: float) -> DataFrame:
    """Index entries of titles: one narrow row per surname and word.

    ``rare`` marks the words of the prefix. A title may be looked up as the shorter of a pair by
    its rare words only, and as the longer one by all.
    """
    words = split_join(_words(titles.select("print", "names", "tokens")), frequency, ["word"])
    # one group per title: as many rows as the title has words
    ordered = words.groupBy("print").agg(
        F.sort_array(F.collect_list(F.struct("_n", "word"))).alias("w"),
        F.any_value("names").alias("names"))
    n = F.size("w")
    placed = ordered.select("print", n.alias("n"), F.explode("names").alias("name"), F.posexplode("w"))
    rare = F.col("pos") <= F.col("n") - _needed(F.col("n"), threshold)
    as_shorter, as_longer = ("d", "a") if tag == "d" else ("a", "d")
    roles = F.when(rare, F.array(F.lit(as_shorter), F.lit(as_longer))).otherwise(
        F.array(F.lit(as_longer)))
    return placed.select(
        "name", F.col("col.word").alias("word"), F.explode(roles).alias("shorter"),
        *[F.col(c).alias(f"{tag}_{c}") for c in ("print", "n", "pos")])


def _needed(n: Column, threshold: float) -> Column:
    """Shared words a title of n words must have; 1e-9 keeps whole products whole."""
    return F.ceil(n * threshold - 1e-9).cast("int")


def _met(sets: DataFrame, articles: DataFrame, threshold: float) -> DataFrame:
    """Pairs of titles that may reach the threshold, each once: d_print, a_print, and ``bound``,
    which the score can't exceed. Only index entries travel for this."""
    frequency = _words(sets.select("tokens")).unionByName(_words(articles.select("tokens"))).groupBy(
        "word").agg(F.count("*").alias("_n"))
    met = _entries(sets, frequency, "d", threshold).join(
        _entries(articles, frequency, "a", threshold), ["name", "word", "shorter"])
    fits = (F.col("shorter") == "d") == (F.col("d_n") <= F.col("a_n"))
    shorter = F.least("d_n", "a_n")
    # a pair's first meeting is under its rarest shared word: from there on, both titles must
    # have enough words left
    left = F.least(F.col("d_n") - F.col("d_pos"), F.col("a_n") - F.col("a_pos"))
    # the shorter title is met under its rare words; the others, one less than needed, may all be shared
    most = F.least(F.count("*") + _needed(F.first("_short"), threshold) - 1, F.first("_short")) / F.first("_short")
    return met.filter(fits).withColumn("_short", shorter).groupBy("d_print", "a_print").agg(
        most.alias("bound"), F.max(left >= _needed(shorter, threshold)).alias("_enough")
    ).filter("_enough").drop("_enough")


def _verified(pairs: DataFrame, sets: DataFrame, articles: DataFrame) -> DataFrame:
    """Pairs with their score; here both word sets travel."""
    d_titles = sets.select(F.col("print").alias("d_print"), F.col("tokens").alias("d_tokens"))
    a_titles = articles.select(F.col("print").alias("a_print"), F.col("tokens").alias("a_tokens"),
                               "article_doi", "article_index")
    full = split_join(split_join(pairs.select("d_print", "a_print"), d_titles, ["d_print"]), a_titles, ["a_print"])
    return full.select("d_print", "a_print", "article_doi", "article_index",
                       overlap(F.col("d_tokens"), F.col("a_tokens")).alias("score"))


def _scored(sets: DataFrame, articles: DataFrame, threshold: float) -> DataFrame:
    """All pairs of titles that may reach the threshold, each once, with their score."""
    return _verified(_met(sets, articles, threshold), sets, articles)


def _top_scored(sets: DataFrame, articles: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs of `_scored` enough to hold each data set's best, equally good ones included.

    Pairs are met once and land in the scratch folder. For every data set title the pair with the
    greatest bound is verified first, and then only those whose bound reaches the score it got.
    """
    folder = scratch_folder(sets.sparkSession, "linkage", local=True)

    def landed(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    pairs = landed(_met(sets, articles, threshold), "pairs")
    lead = pairs.groupBy("d_print").agg(F.max_by("a_print", F.struct("bound", "a_print")).alias("a_print"))
    first = landed(_verified(lead, sets, articles), "first")
    got = first.select("d_print", F.col("a_print").alias("_lead"), "score")
    rest = split_join(pairs, got, ["d_print"]).filter(
        (F.col("a_print") != F.col("_lead")) & (F.col("bound") >= F.col("score") - 1e-9))
    return first.unionByName(landed(_verified(rest, sets, articles), "rest"))


def _distinct_titles(prepared: DataFrame, *more: Column) -> DataFrame:
    # a title without words drops out when its words are listed
    return prepared.withColumn("print", _fingerprint()).groupBy("print").agg(
        F.any_value("tokens").alias("tokens"), F.any_value("names").alias("names"), *more)


def _titles(datasets: DataFrame, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct titles of data sets without a DOI of their own, and of articles."""
    sets = _distinct_titles(_prepared_datasets(datasets).filter(F.col("direct_doi").isNull()))
    arts = _distinct_titles(
        _prepared_articles(articles),
        F.min_by("article_doi", "article_index").alias("article_doi"),
        F.min("article_index").alias("article_index"))
    return sets, arts


def link_candidates(datasets: DataFrame, articles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scored pairs of distinct titles: prints of data set and article title, and the first
    article with that title."""
    return _scored(*_titles(datasets, articles), threshold).filter(F.col("score") >= threshold)


def best_match(candidates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The best article per data set print; of equal scores the first article."""
    order = F.struct(F.col("score"), -F.col("article_index"))
    return candidates.groupBy("d_print").agg(
        F.max_by("article_doi", order).alias("article_doi"), F.max("score").alias("score")
    ).filter(F.col("score") >= threshold)


def link_articles(datasets: DataFrame, articles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each data set with its article's DOI, or null: the DOI it cites itself, else the best title
    match. ``articles`` holds doi, title, authors (surnames) and article_index, its order."""
    prepared = _prepared_datasets(datasets).withColumn("d_print", _fingerprint())
    best = best_match(_top_scored(*_titles(datasets, articles), threshold), threshold)
    cited = F.col("direct_doi").isNotNull()
    linked = split_join(prepared, best, ["d_print"], "left")
    return linked.select(
        "package_doi",
        F.when(cited, F.col("direct_doi")).otherwise(F.col("article_doi")).alias("article_doi"),
        F.when(cited, F.lit("cited")).when(F.col("article_doi").isNotNull(), "title").alias("method"),
        F.when(~cited, F.col("score")).alias("score"),
    )


def metrics(
    links: DataFrame, downloads: DataFrame, citations: DataFrame, articles: DataFrame
) -> DataFrame:
    """Linked packages with downloads, citations and the article's date, where landed.

    ``downloads`` holds (package_doi, downloads), ``citations`` (article_doi, citations) and
    ``articles`` (doi, pub_date).
    """
    dates = articles.select(F.col("doi").alias("article_doi"), F.col("pub_date").alias("article_pub_date"))
    return (
        links.filter(F.col("article_doi").isNotNull()).select("package_doi", "article_doi")
        .join(downloads, "package_doi", "left")
        .join(citations, "article_doi", "left")
        .join(dates, "article_doi", "left")
        .select("package_doi", "article_doi", "downloads", "citations", "article_pub_date")
    )
