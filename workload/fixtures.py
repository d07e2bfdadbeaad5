"""Review-workflow tables derived from the given tables by SQL that Spark and DuckDB share.

Views build on each other; a query's WITH clause holds just those it needs. ``{ts}`` is the
engine's name for a timestamp without zone.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from galleyproof.session import PACKED, scratch_folder

AS_OF = dt.date(2002, 2, 1)
AS_OF_SQL = "DATE '2002-02-01'"
LANDED_ROWS = 1 << 18  # of a file of a landed view, at most
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    # rounds are numbered by ship date; stage is the paper's place in the workflow
    "li": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_tax, l_discount, l_linenumber,
               l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS d0, l_orderkey % 7 AS stage,
               CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey
                    ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS INT) AS round,
               CAST(COUNT(*) OVER (PARTITION BY l_orderkey) AS INT) AS n_rounds
        FROM lineitem""",
    "it": "SELECT *, CASE WHEN round < n_rounds THEN 9 ELSE stage END AS st FROM li",
    "iterations": """
        SELECT CAST(l_orderkey AS STRING) AS paper_id, round, 'Review' AS journal,
            CONCAT('Author', l_orderkey % 1000, '-', l_orderkey) AS paper_slug,
            CONCAT('Author', l_orderkey % 1000) AS surname_of_author,
            CASE WHEN l_orderkey % 40 = 0 THEN '[TEST]' END AS comments,
            CASE WHEN st >= 3 THEN CONCAT('repl', l_suppkey, '@example.org') END AS replicator1,
            CASE WHEN st >= 3 AND l_linenumber % 3 = 0
                 THEN CONCAT('repl', (l_suppkey + 1) % 100, '@example.org') END AS replicator2,
            CASE WHEN st >= 4 THEN CAST(l_quantity / 10 AS DECIMAL(18,3)) END AS hours1,
            CASE WHEN st >= 4 AND l_linenumber % 3 = 0
                 THEN CAST(l_tax * 100 AS DECIMAL(18,3)) END AS hours2,
            CASE WHEN st >= 4 THEN CAST(l_discount * 10 AS DECIMAL(18,3)) END AS runtime_code_hours,
            CASE WHEN st >= 4 THEN l_returnflag <> 'R' END AS is_success,
            CASE WHEN st >= 4 THEN l_linenumber % 2 = 0 END AS is_confidential,
            l_linenumber % 4 = 1 AS share_confidential,
            CASE WHEN st >= 4 THEN l_linenumber % 4 = 0 END AS is_confidential_shared,
            CASE WHEN st >= 4 THEN l_returnflag = 'A' END AS is_remote,
            CASE WHEN st >= 4 THEN l_linestatus = 'F' END AS is_HPC,
            CASE WHEN st >= 4 THEN CASE l_partkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'Stata'
                 ELSE 'Python' END END AS software,
            CASE WHEN st >= 4 AND l_partkey % 5 > 0
                 THEN CONCAT('Statement ', l_partkey) END AS data_statement,
            CASE WHEN st >= 4 THEN CONCAT('Report on line ', l_linenumber) END AS repl_comments,
            CASE WHEN l_partkey % 4 > 0 THEN CONCAT('org/repo-', l_orderkey) END AS gh_org_repo,
            CASE l_linenumber % 3 WHEN 0 THEN 'gh-runner' WHEN 1 THEN 'local' END AS preprocess_mode,
            CONCAT('pkg-', l_orderkey, '-', round) AS file_request_id_pkg,
            CONCAT('pap-', l_orderkey, '-', round) AS file_request_id_paper,
            CASE WHEN l_linenumber % 2 = 0 THEN CONCAT('https://files.example.org/', l_orderkey) END
                 AS file_request_url_pkg,
            CASE WHEN round = 1 THEN d0 - 3 END AS first_arrival_date,
            CASE WHEN st >= 1 THEN d0 END AS date_with_authors,
            CASE WHEN st >= 2 THEN d0 + 5 END AS date_arrived_from_authors,
            CASE WHEN st >= 3 THEN d0 + 7 END AS date_assigned_repl,
            CASE WHEN st >= 4 THEN d0 + 7 + CAST(l_quantity AS INT) END AS date_completed_repl,
            CASE WHEN st >= 5 THEN d0 + 9 + CAST(l_quantity AS INT) END AS date_decision_de,
            CASE WHEN st = 9 THEN 'rnr' WHEN st >= 5 THEN 'accept' END AS decision_de
        FROM it""",
    "last_it": """
        SELECT paper_id, round, date_decision_de FROM (
            SELECT paper_id, round, date_decision_de,
                   ROW_NUMBER() OVER (PARTITION BY paper_id ORDER BY round DESC) AS rn
            FROM iterations) x WHERE rn = 1""",
    "papers": """
        SELECT CAST(o_orderkey AS STRING) AS paper_id, 'Review' AS journal,
            CONCAT('Study ', o_orderkey) AS title,
            CONCAT('First', o_custkey) AS firstname_of_author,
            CONCAT('Author', o_orderkey % 1000) AS surname_of_author,
            CONCAT('Author', o_orderkey % 1000, '-', o_orderkey) AS paper_slug,
            CASE WHEN o_orderkey % 50 = 13 THEN 'with_author'
                 WHEN o_orderkey % 7 = 0 THEN 'new_arrival' WHEN o_orderkey % 7 = 1 THEN 'with_author'
                 WHEN o_orderkey % 7 = 2 THEN 'author_back_de'
                 WHEN o_orderkey % 7 = 3 THEN 'with_replicator'
                 WHEN o_orderkey % 7 = 4 THEN 'replicator_back_de'
                 WHEN o_orderkey % 7 = 5 THEN 'acceptable_package'
                 ELSE 'published_package' END AS status,
            COALESCE(l.round, 1) AS round,
            CAST(o_orderdate AS DATE) AS first_arrival_date,
            CAST(o_orderdate AS DATE) + 1 AS date_with_authors,
            CASE WHEN o_orderkey % 7 = 6 THEN l.date_decision_de + 10 END AS date_published,
            o_orderstatus = 'P' AS is_confidential,
            CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 3 = 1 END AS share_confidential,
            CASE WHEN o_custkey % 2 = 0 THEN TRUE END AS is_remote,
            CASE WHEN o_custkey % 5 = 0 THEN FALSE END AS is_HPC,
            CASE WHEN o_custkey % 4 = 0 THEN 'Known data' END AS data_statement,
            CASE WHEN o_custkey % 4 = 1 THEN 'Julia' END AS software,
            CASE WHEN o_orderkey % 7 = 6 THEN CONCAT('doi:10.7000/', o_orderkey) END AS doi,
            CONCAT('pkg-', o_orderkey) AS file_request_id_pkg,
            CONCAT('pap-', o_orderkey) AS file_request_id_paper,
            CASE WHEN o_orderkey % 40 = 0 THEN '[TEST]' END AS comments
        FROM orders LEFT JOIN last_it l ON l.paper_id = CAST(o_orderkey AS STRING)""",
    "replicators": """
        SELECT CONCAT('repl', s_suppkey, '@example.org') AS email, s_name AS name,
            CASE s_suppkey % 5 WHEN 0 THEN 'macOS 14' WHEN 1 THEN 'Windows 11'
                 WHEN 2 THEN 'Ubuntu 22.04' WHEN 3 THEN 'Darwin' END AS os,
            CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS can_take,
            CAST(s_nationkey AS INT) AS current_workload,
            CONCAT('INV-', s_suppkey + 10) AS invoice
        FROM supplier""",
    # open rounds; finished ones, some with another replicator; and rounds that do not exist
    "reports": """
        SELECT CAST(d0 + 7 + CAST(l_quantity AS INT) AS {ts}) AS timestamp,
            CAST(l_orderkey AS STRING) AS paper_id, 'Review' AS journal,
            round + CASE WHEN l_linenumber = 5 AND st = 3 THEN 50 ELSE 0 END AS round,
            CASE WHEN l_linenumber = 7 THEN 'other@example.org'
                 WHEN l_linenumber <> 6 THEN CONCAT('repl', l_suppkey, '@example.org') END
                 AS email_of_replicator_1,
            CASE WHEN l_linenumber % 3 = 0 THEN CONCAT('repl', (l_suppkey + 1) % 100, '@example.org')
                 END AS email_of_replicator_2,
            CAST(l_quantity / 8 AS DECIMAL(18,3)) AS hours_replicator_1,
            CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_tax * 50 AS DECIMAL(18,3)) END
                 AS hours_replicator_2,
            CASE l_partkey % 2 WHEN 0 THEN 'R' ELSE 'Matlab' END AS software_used_in_package,
            CASE WHEN l_partkey % 3 > 0 THEN CONCAT('Report statement ', l_partkey) END
                 AS data_statement,
            CONCAT('Checked ', l_linenumber) AS comments,
            CAST(l_discount * 10 AS DECIMAL(18,3)) AS running_time_of_code,
            l_returnflag <> 'R' AS is_success, l_linenumber % 2 = 1 AS is_confidential,
            l_linenumber % 3 = 1 AS shared_confidential, l_returnflag = 'N' AS is_remote,
            l_linestatus = 'O' AS is_HPC
        FROM it WHERE st >= 3""",
    "raw_arrivals": """
        SELECT ts, CASE user_id % 4 WHEN 0 THEN 'Review' ELSE 'Review:Micro' END AS journal,
            CONCAT(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END, '.0') AS manuscript_id,
            CONCAT('Paper ', event_id) AS title, CONCAT('First', user_id) AS first_name,
            CASE user_id % 6 WHEN 0 THEN 'Müller' WHEN 1 THEN 'O''Brien' WHEN 2 THEN 'García  Peña'
                 WHEN 3 THEN 'smith-jones' WHEN 4 THEN 'Łukasz Øster' ELSE 'Đặng Ström' END AS last_name,
            CONCAT('author', user_id, '@example.org') AS email,
            CASE WHEN user_id % 3 = 0 THEN CONCAT('second', user_id, '@example.org') END AS email2,
            CONCAT('Editor ', user_id % 9) AS editor,
            CASE WHEN event_type = 'error' THEN 'No - Pure theory paper'
                 WHEN event_type <> 'view' THEN 'Yes - numerical' END AS theory,
            CASE event_type WHEN 'click' THEN 'Yes' WHEN 'signup' THEN 'no' END AS confidential,
            CASE event_type WHEN 'click' THEN 'YES' WHEN 'purchase' THEN 'No' END AS shareable,
            CASE WHEN event_id % 25 = 0 THEN '[TEST]' END AS comments
        FROM events""",
    "form_arrivals": """
        SELECT ts AS timestamp, CAST(event_id * 2 AS STRING) AS paper_id, 'Review' AS journal,
            CONCAT('Paper ', event_id) AS title, CONCAT('Author', event_id % 1000) AS surname_of_author,
            CASE WHEN event_id % 25 = 0 THEN '[TEST]' END AS comments,
            event_type <> 'click' AS processed
        FROM events""",
    "uploads": """
        SELECT CAST(event_id AS STRING) AS paper_id, ts,
            CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'package' ELSE 'paper' END AS kind,
            CAST(FLOOR(value) AS BIGINT) % 3 AS file_count
        FROM events
        UNION ALL
        SELECT CAST(event_id AS STRING) AS paper_id, ts, 'paper' AS kind, user_id % 2 AS file_count
        FROM events WHERE event_type IN ('click', 'view')""",
    "packages": """
        SELECT CONCAT('org/repo-', l_orderkey) AS gh_org_repo, round
        FROM it WHERE l_quantity > 25""",
    # pages as articles and data sets: the title element is the title and the host the surname;
    # the data set's title has its words on "t" changed, so scores vary
    "titled": """
        SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
            split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS source,
            CAST(length(html) AS BIGINT) AS n_chars
        FROM pages""",
    "articles": """
        SELECT CONCAT('10.9000/', page_id) AS doi, title, source, page_id AS article_index
        FROM titled""",
    "datasets": """
        SELECT CONCAT('doi:10.7910/', page_id) AS global_id,
            CONCAT('Replication Data for: "', regexp_replace(title, '(^|[ ])[tT]', ' x'{all}), '"') AS name,
            CONCAT(source, ', Ada') AS author,
            CASE WHEN n_chars % 10 = 0
                 THEN CONCAT('Ada (2020), https://doi.org/10.1086/', page_id, ').') END AS citation,
            CASE WHEN n_chars % 3 = 0 THEN 'Published' ELSE 'Draft' END AS state,
            CASE WHEN n_chars % 7 > 0 THEN CONCAT('2001-', CASE WHEN n_chars % 2 = 0 THEN '12' ELSE '10' END,
                 '-15T08:30:00Z') ELSE 'unknown' END AS updated,
            n_chars / 100.0 AS size_mb, n_chars, page_id AS doc_id
        FROM titled""",
    "manifest": """
        SELECT regexp_replace(url, '^https?://', '') AS path,
            split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS package,
            CAST(length(html) AS BIGINT) AS size, md5(html) AS md5, page_id
        FROM pages""",
    "local_files": """
        SELECT CONCAT('data/', CASE page_id % 6 WHEN 0 THEN 'preserve-docs/' WHEN 1 THEN
               'code/thirdparty/x/' ELSE '' END, 'file', page_id, '.html') AS path, size, md5
        FROM manifest WHERE page_id % 7 <> 3
        UNION ALL
        SELECT CONCAT('copy/file', page_id, '.html') AS path, size, md5
        FROM manifest WHERE page_id % 11 = 0""",
    "remote_files": """
        SELECT CASE WHEN page_id % 5 = 0 THEN CONCAT('renamed', page_id, '.html')
               ELSE CONCAT('file', page_id, '.html') END AS filename, md5
        FROM manifest WHERE page_id % 13 <> 4""",
    # latest rounds, and the days of every paper in its state: for oracles only
    "latest_it": """
        SELECT * FROM iterations QUALIFY ROW_NUMBER() OVER (PARTITION BY paper_id ORDER BY round DESC) = 1""",
    "aged": f"""
        SELECT p.*, CAST({AS_OF_SQL} - CASE p.status
                WHEN 'new_arrival' THEN p.first_arrival_date
                WHEN 'with_author' THEN i.date_with_authors
                WHEN 'author_back_de' THEN i.date_arrived_from_authors
                WHEN 'with_replicator' THEN i.date_assigned_repl
                WHEN 'replicator_back_de' THEN i.date_completed_repl
                WHEN 'acceptable_package' THEN i.date_decision_de
                WHEN 'published_package' THEN p.date_published END AS INT) AS days_in_status
        FROM papers p LEFT JOIN iterations i ON p.paper_id = i.paper_id AND p.round = i.round""",
    "worked": """
        SELECT date_completed_repl, CAST(date_completed_repl - date_assigned_repl AS INT) AS days_taken,
            1 AS slot, replicator1 AS replicator, hours1 AS hours,
            CONCAT(journal, '-', paper_slug, '-R', round) AS case_id, comments
        FROM iterations WHERE date_completed_repl IS NOT NULL
        UNION ALL
        SELECT date_completed_repl, CAST(date_completed_repl - date_assigned_repl AS INT) AS days_taken,
            2 AS slot, replicator2 AS replicator, hours2 AS hours,
            CONCAT(journal, '-', paper_slug, '-R', round) AS case_id, comments
        FROM iterations
        WHERE date_completed_repl IS NOT NULL AND replicator2 IS NOT NULL AND hours2 IS NOT NULL""",
}

#: Views as Spark derives them where that takes less than the shared text; the rows are the same. A paper's
#: latest round is the one whose number is the count of its rounds, so no window over the rounds is needed.
SPARK_VIEWS = {
    "last_it": """
        SELECT CAST(l_orderkey AS STRING) AS paper_id, round,
            CASE WHEN st >= 5 THEN d0 + 9 + CAST(l_quantity AS INT) END AS date_decision_de
        FROM it WHERE round = n_rounds""",
}

_TOKENS = {
    "spark": {"{ts}": "TIMESTAMP_NTZ", "{nl}": "'\\n'", "{all}": ""},
    "duckdb": {"{ts}": "TIMESTAMP", "{nl}": "chr(10)", "{all}": ", 'g'"},
}


def needed(sql: str, texts: Mapping[str, str] = VIEWS) -> list[str]:
    """Views a text refers to, directly or through others, in order of definition."""
    found: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_]+\b", text)):
            if word in VIEWS and word not in found:
                found.add(word)
                visit(texts[word])

    visit(sql)
    return [name for name in VIEWS if name in found]


def _render(text: str, engine: str) -> str:
    for token, value in _TOKENS[engine].items():
        text = text.replace(token, value)
    return text


def oracle(sql: str) -> str:
    """A query for DuckDB, which has the given tables as views."""
    parts = [f"{n} AS ({_render(VIEWS[n], 'duckdb')})" for n in needed(sql)]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql


class Fixtures:
    """Fixture views as DataFrames, by attribute. With ``saved`` (a folder written by `save`)
    they are read from there instead of being derived."""

    def __init__(self, spark: SparkSession, sf_dir: str, saved: str | None = None):
        self.spark, self.sf_dir, self.saved = spark, sf_dir.rstrip("/"), saved
        self.texts = VIEWS | SPARK_VIEWS

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.given(name)
        if name not in VIEWS:
            raise AttributeError(name)
        if self.saved:
            return self.spark.read.parquet(f"{self.saved}/{name}")
        body = self.texts[name]
        views = needed(body, self.texts)
        text = " ".join([body, *(self.texts[v] for v in views)])
        base = [
            f"{g} AS (SELECT * FROM parquet.`{self.sf_dir}/{g}.parquet`)"
            for g in GIVEN if re.search(rf"\bFROM {g}\b", text)
        ]
        parts = [f"{v} AS ({_render(self.texts[v], 'spark')})" for v in views]
        heads = f"WITH {', '.join(base + parts)} " if base + parts else ""
        return self.spark.sql(heads + _render(body, "spark"))

    def landed(self, *names: str) -> Fixtures:
        """The same views, of which ``names`` and those built on them read files that are written
        now: a query that needs a view more than once derives it once. Files are small, so that the
        tasks that read them are equally long; what is derived from a row costs far more than reading it."""
        if self.saved:
            return self
        told, folder = Fixtures(self.spark, self.sf_dir), scratch_folder(self.spark, "views", local=True)
        told.texts = self.texts
        for name in names:
            rows = getattr(told, name).write.options(**PACKED, maxRecordsPerFile=LANDED_ROWS)
            rows.parquet(f"{folder}/{name}")
            told.texts = told.texts | {name: f"SELECT * FROM parquet.`{folder}/{name}`"}
        return told

    def save(self, folder: str, names: list[str], files: int) -> Fixtures:
        """Write views as Parquet tables of so many files each, to be scanned in parallel."""
        for name in names:
            getattr(self, name).repartition(files).write.mode("overwrite").parquet(f"{folder}/{name}")
        return Fixtures(self.spark, self.sf_dir, folder)
