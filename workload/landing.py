"""Files written from the given tables and read back through the sources."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galleyproof.plans import linkage
from galleyproof.session import scratch_folder
from galleyproof.sources import catalog_listing, file_manifest, read_articles, read_datasets, read_form
from galleyproof.sources.files import _qualified, open_system

from .basics import catalogue
from .linking import _LINKS, dataset_json
from .registry import query


@query("read_datasets", """
    SELECT d.global_id, CAST(len(string_split(x.text, chr(10))) AS INT) AS n_files, d.author AS first_author, d.citation
    FROM datasets d JOIN documents x ON x.doc_id = d.doc_id""")
def _(t):
    folder = scratch_folder(t.spark, "json", local=True)
    records = catalogue(t).drop("n_chars", "doc_id").join(dataset_json(t), "global_id")
    records.write.json(f"{folder}/datasets")
    found = read_datasets(t.spark, f"{folder}/datasets")
    return found.select(
        "global_id", F.size("files").alias("n_files"), F.get("authors", F.lit(0)).alias("first_author"),
        F.get("publications", F.lit(0))["citation"].alias("citation"))


@query("read_articles", """
    SELECT CONCAT('10.9000/', doc_id) AS doi, text AS title,
        CASE WHEN doc_id % 2 = 0 THEN DATE '2021-05-01' ELSE DATE '2021-01-01' END AS pub_date, source AS author
    FROM documents WHERE lang <> 'fr' AND doc_id % 13 > 0""")
def _(t):
    folder = scratch_folder(t.spark, "json", local=True)
    key = F.col("doc_id")
    # one language stands for front matter without authors, some records lack a date
    author = F.struct(F.upper("source").alias("family"))
    parts = F.when(key % 2 == 0, F.array(F.lit(2021), F.lit(5))).otherwise(F.array(F.lit(2021)))
    dated = F.when(key % 13 > 0, F.array(parts)).otherwise(F.array(F.array(F.lit(None).cast("int"))))
    t.documents.select(
        F.concat(F.lit("10.9000/"), key.cast("string")).alias("DOI"),
        F.array("text").alias("title"),
        F.when(F.col("lang") == "fr", F.array().cast("array<struct<family:string>>"))
        .otherwise(F.array(author)).alias("author"),
        F.struct(dated.alias("date-parts")).alias("published"),
    ).write.json(f"{folder}/articles")
    found = read_articles(t.spark, f"{folder}/articles")
    return found.select("doi", "title", "pub_date", F.get("authors", F.lit(0)).alias("author"))


def _landed_articles(t, folder):
    """Articles as landed files: records in the order of the articles, one file per range of it."""
    author = F.struct(F.upper("source").alias("family"))
    records = t.articles.repartitionByRange("article_index").sortWithinPartitions("article_index").select(
        F.col("doi").alias("DOI"), F.array("title").alias("title"), F.array(author).alias("author"),
        F.struct(F.array(F.array(F.lit(2021))).alias("date-parts")).alias("published"))
    records.write.json(f"{folder}/articles")
    return read_articles(t.spark, f"{folder}/articles")


@query("read_articles_order", "SELECT doi, ROW_NUMBER() OVER (ORDER BY article_index) - 1 AS article_index FROM articles")
def _(t):
    """The place of every article over all landed files."""
    return _landed_articles(t, scratch_folder(t.spark, "json", local=True)).select("doi", "article_index")


@query("link_landed_articles", _LINKS)
def _(t):
    """Data sets linked to articles that are read from landed files, which tell their order."""
    found = _landed_articles(t, scratch_folder(t.spark, "json", local=True))
    return linkage.link_articles(catalogue(t), found)


@query("catalog_listing", " UNION ALL ".join(
    f"SELECT 'listed_{n}' AS table_name, COUNT(*) AS n_rows, TRUE AS has_bytes, {w} AS n_columns, TRUE AS is_temporary FROM {n}"
    for n, w in (("orders", 6), ("events", 6), ("documents", 5)))
    + " UNION ALL SELECT 'listed_view', COUNT(*), FALSE, 1, TRUE FROM (SELECT DISTINCT lang FROM documents) x")
def _(t):
    """Stored tables and a computed view of the catalog, with rows, bytes and columns."""
    for name in ("orders", "events", "documents"):
        t.spark.read.parquet(f"{t.sf_dir}/{name}.parquet").createOrReplaceTempView(f"listed_{name}")
    t.documents.select("lang").distinct().createOrReplaceTempView("listed_view")
    listed = catalog_listing(t.spark, "listed_*")
    return listed.select("table_name", "n_rows", F.coalesce(F.col("bytes") > 0, F.lit(False)).alias("has_bytes"),
                         "n_columns", "is_temporary")


@query("read_form", """
    SELECT title AS manuscript_title, journal AS please_indicate_the_journal,
        last_name AS surname_of_author, email2 AS "email_of_second_author_(if_applicable)" FROM raw_arrivals""")
def _(t):
    folder = scratch_folder(t.spark, "form", local=True)
    names = ["Manuscript title", "Please indicate the journal", "Surname of author",
             "Email of second author (if applicable)"]
    sheet = t.raw_arrivals.select("title", "journal", "last_name", "email2").toDF(*names)
    sheet.write.csv(f"{folder}/sheet", header=True, quote='"', escape='"')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_form(t.spark, f"{folder}/sheet", schema)


def _land_pages(root, batches):
    """Sorted pages as text files ``page_id=<id>/part-<task>.txt`` under ``root``, a line for each row, as
    ``partitionBy`` writes them. Tasks put every file in its place: on a local disk Spark's writer starts
    several processes per file to set its rights, and its committer moves all files one after another."""
    name, held, out = f"part-{TaskContext.get().partitionId():05d}.txt", None, None
    for batch in batches:
        paths = []
        for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
            path = f"{root}/page_id={'__HIVE_DEFAULT_PARTITION__' if page is None else page}"
            if path != held:
                if out is not None:
                    out.close()
                system, inner = open_system(path)
                system.create_dir(inner)
                held, out = path, system.open_output_stream(f"{inner}/{name}")
                paths.append(path)
            out.write((html or "").encode() + b"\n")
        yield pa.record_batch([pa.array(paths, pa.string())], names=["path"])
    if out is not None:
        out.close()


@query("file_manifest", """
    SELECT CONCAT('page_id=', page_id) AS folder, CAST(strlen(html) + 1 AS BIGINT) AS size,
        md5(html || chr(10)) AS md5 FROM pages""")
def _(t):
    folder = scratch_folder(t.spark, "package", local=True)
    root = _qualified(t.spark, f"{folder}/package")
    t.pages.select("page_id", "html").sortWithinPartitions("page_id").mapInArrow(
        partial(_land_pages, root), "path string").write.format("noop").mode("overwrite").save()
    listed = file_manifest(t.spark, f"{folder}/package").filter(F.col("basename").startswith("part-"))
    return listed.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("folder"), "size", "md5")
