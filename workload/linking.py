"""Packages, file lists and links to articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from galleyproof.plans import linkage, packages

from .basics import catalogue
from .functions import _TITLE
from .registry import query

_TITLED = r"""
    SELECT global_id, source, citation, doc_id, """ + _TITLE.format(c=r"""trim(regexp_replace(name,
        '^Replication (Data|Code|Codes)( and Instructions)? for:?\s*', '', 'i'), '"“” ')""") + """ AS toks
    FROM (SELECT d.*, lower(split_part(author, ',', 1)) AS source FROM datasets d) s"""
_PAIRS = f"""
    SELECT d.global_id, a.doi, a.article_index,
        CAST(len(list_intersect(d.toks, a.toks)) AS DOUBLE) / least(len(d.toks), len(a.toks)) AS score
    FROM ({_TITLED}) d JOIN (SELECT doi, article_index, source, {_TITLE.format(c='title')} AS toks
        FROM articles) a ON a.source = d.source
    WHERE d.citation IS NULL AND len(d.toks) > 0 AND len(a.toks) > 0"""
_LINKS = f"""
    SELECT d.global_id AS package_doi,
        CASE WHEN d.citation IS NOT NULL THEN CONCAT('10.1086/', d.doc_id) ELSE b.doi END AS article_doi,
        CASE WHEN d.citation IS NOT NULL THEN 'cited' WHEN b.doi IS NOT NULL THEN 'title' END AS method,
        CASE WHEN d.citation IS NULL THEN b.score END AS score
    FROM datasets d LEFT JOIN (SELECT * FROM ({_PAIRS}) p WHERE score >= 0.6
        QUALIFY ROW_NUMBER() OVER (PARTITION BY global_id ORDER BY score DESC, article_index) = 1) b
        ON b.global_id = d.global_id"""


def article_table(t):
    return t.articles.select("doi", "title", "article_index", F.array(F.lower("source")).alias("authors"))


# distinct titles, each known by a hash of its words and surname; of equal articles the first
_PRINT = "upper(sha256(array_to_string(list_sort(toks), ' ') || chr(10) || source))"
_SCORED = f"""
    SELECT DISTINCT d.title_print, a.article_doi, a.article_index,
        CAST(len(list_intersect(d.toks, a.toks)) AS DOUBLE) / least(len(d.toks), len(a.toks)) AS score
    FROM (SELECT {_PRINT} AS title_print, ANY_VALUE(toks) AS toks, ANY_VALUE(source) AS source
          FROM ({_TITLED}) x WHERE citation IS NULL AND len(toks) > 0 GROUP BY 1) d
    JOIN (SELECT {_PRINT} AS title_print, ANY_VALUE(toks) AS toks, ANY_VALUE(source) AS source,
              arg_min(doi, article_index) AS article_doi, MIN(article_index) AS article_index
          FROM (SELECT doi, article_index, source, {_TITLE.format(c='title')} AS toks FROM articles) y
          WHERE len(toks) > 0 GROUP BY 1) a ON a.source = d.source"""


@query("link_candidates", f"SELECT title_print, article_doi, score FROM ({_SCORED}) s WHERE score >= 0.6")
def _(t):
    pairs = linkage.link_candidates(catalogue(t), article_table(t))
    return pairs.select(F.hex("d_print").alias("title_print"), "article_doi", "score")


@query("best_match", f"""
    SELECT title_print, article_doi, score FROM ({_SCORED}) s WHERE score >= 0.75
    QUALIFY ROW_NUMBER() OVER (PARTITION BY title_print ORDER BY score DESC, article_index) = 1""")
def _(t):
    best = linkage.best_match(linkage.link_candidates(catalogue(t), article_table(t), 0.75), 0.75)
    return best.select(F.hex("d_print").alias("title_print"), "article_doi", "score")


@query("link_articles", _LINKS)
def _(t):
    return linkage.link_articles(catalogue(t), article_table(t))


@query("metrics", f"""
    SELECT l.package_doi, l.article_doi, w.downloads, c.citations, a.pub_date AS article_pub_date
    FROM ({_LINKS}) l
    LEFT JOIN (SELECT CONCAT('doi:10.7910/', doc_id) AS package_doi, doc_id * 3 AS downloads
        FROM documents WHERE lang = 'en') w ON w.package_doi = l.package_doi
    LEFT JOIN (SELECT CONCAT('10.9000/', doc_id) AS article_doi, quality AS citations FROM labels) c
        ON c.article_doi = l.article_doi
    LEFT JOIN (SELECT doi, DATE '2000-01-01' + CAST(article_index % 900 AS INT) AS pub_date FROM articles) a
        ON a.doi = l.article_doi
    WHERE l.article_doi IS NOT NULL""")
def _(t):
    key = F.col("doc_id").cast("string")
    downloads = t.documents.filter("lang = 'en'").select(
        F.concat(F.lit("doi:10.7910/"), key).alias("package_doi"), (F.col("doc_id") * 3).alias("downloads"))
    citations = t.labels.select(
        F.concat(F.lit("10.9000/"), key).alias("article_doi"), F.col("quality").alias("citations"))
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("article_index") % 900).cast("int"))
    dates = t.articles.select("doi", day.alias("pub_date"))
    links = linkage.link_articles(catalogue(t), article_table(t))
    return linkage.metrics(links, downloads, citations, dates)


@query("reconcile", """
    SELECT COALESCE(l.md5, r.md5) AS md5, l.path AS local_path, l.base AS local_name, r.name AS remote_name,
        CASE WHEN l.md5 IS NULL THEN 'only_remote' WHEN r.md5 IS NULL THEN 'only_local'
             WHEN l.base = r.name THEN 'matched' ELSE 'name_differs' END AS outcome
    FROM (SELECT md5, MIN(path) AS path, regexp_extract(MIN(path), '[^/]*$') AS base
          FROM local_files GROUP BY md5) l
    FULL JOIN (SELECT md5, MIN(filename) AS name FROM remote_files GROUP BY md5) r ON l.md5 = r.md5""")
def _(t):
    return packages.reconcile(t.local_files, t.remote_files)


def dataset_json(t):
    """Each document as a data set whose files are its lines."""
    line = lambda x, i: F.struct(F.struct(
        F.concat(F.lit("line"), i.cast("string")).alias("filename"),
        F.length(x).cast("bigint").alias("filesize"), F.md5(x).alias("md5")).alias("dataFile"))
    return t.documents.select(
        F.concat(F.lit("doi:10.7910/"), F.col("doc_id").cast("string")).alias("global_id"),
        F.transform(F.split("text", "\n"), line).alias("files"))


@query("dataset_files", """
    SELECT global_id, 'line' || (i - 1) AS filename, CAST(length(parts[i]) AS BIGINT) AS filesize,
        md5(parts[i]) AS md5
    FROM (SELECT global_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
        SELECT CONCAT('doi:10.7910/', doc_id) AS global_id, string_split(text, chr(10)) AS parts
        FROM documents) a) b""")
def _(t):
    return packages.dataset_files(dataset_json(t))


@query("dataset_sizes", """
    SELECT CONCAT('doi:10.7910/', doc_id) AS global_id,
        CAST(length(replace(text, chr(10), '')) AS DOUBLE) / 1048576 AS size_mb FROM documents""")
def _(t):
    return packages.dataset_sizes(dataset_json(t))


@query("retention_plan", """
    SELECT path, size, CASE WHEN regexp_matches(path, '(thirdparty|preserve)[^/]*/') THEN 'keep'
        ELSE 'delete' END AS action FROM local_files""")
def _(t):
    return packages.retention_plan(t.local_files)
