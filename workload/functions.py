"""One query per scalar function."""

from __future__ import annotations

from pyspark.sql import functions as F

from galleyproof import functions as fn

from .registry import query

_TITLE = r"""
    list_distinct(list_filter(string_split_regex(
        regexp_replace(strip_accents(lower({c})), '[^a-z0-9\s]', ' ', 'g'), '\s+'), lambda x: x <> ''))"""


def first_line(c):
    return F.split_part(c, F.lit("\n"), F.lit(1))


@query("yesno_bool", """
    SELECT email, CASE WHEN lower(confidential) = 'yes' THEN TRUE ELSE FALSE END AS flag
    FROM raw_arrivals""")
def _(t):
    return t.raw_arrivals.select("email", fn.yesno_bool(F.col("confidential")).alias("flag"))


@query("parse_bool", "SELECT title, lower(shareable) = 'yes' AS flag FROM raw_arrivals")
def _(t):
    return t.raw_arrivals.select("title", fn.parse_bool(F.col("shareable")).alias("flag"))


@query("na_default", "SELECT title, COALESCE(email2, 'NA') AS email2 FROM raw_arrivals")
def _(t):
    return t.raw_arrivals.select("title", fn.na_default(F.col("email2")).alias("email2"))


@query("is_draft", "SELECT global_id, upper(state) = 'DRAFT' AS draft FROM datasets")
def _(t):
    return t.datasets.select("global_id", fn.is_draft(F.upper("state")).alias("draft"))


@query("case_id", """
    SELECT journal || '-' || surname_of_author || '-' || paper_id || '-R' || round AS case_id FROM papers""")
def _(t):
    cols = [F.col(c) for c in ("journal", "surname_of_author", "paper_id", "round")]
    return t.papers.select(fn.case_id(*cols).alias("case_id"))


@query("case_path", "SELECT journal || '/' || paper_slug || '/' || round AS path FROM papers")
def _(t):
    return t.papers.select(
        fn.case_path(F.col("journal"), F.col("paper_slug"), F.col("round")).alias("path"))


@query("paper_slug", """
    SELECT surname_of_author || '-' || paper_id AS slug,
        journal || '-' || surname_of_author || '-' || paper_id AS journal_slug FROM papers""")
def _(t):
    last, pid, journal = F.col("surname_of_author"), F.col("paper_id"), F.col("journal")
    return t.papers.select(fn.paper_slug(last, pid).alias("slug"),
                           fn.paper_slug(last, pid, journal).alias("journal_slug"))


@query("clean_journal", "SELECT title, replace(journal, ':', '-') AS journal FROM raw_arrivals")
def _(t):
    return t.raw_arrivals.select("title", fn.clean_journal(F.col("journal")).alias("journal"))


@query("paper_id", """
    SELECT value, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS from_number,
        CAST(CAST(floor(TRY_CAST(manuscript_id AS DOUBLE)) AS BIGINT) AS VARCHAR) AS from_text,
        CAST(CAST(floor(TRY_CAST(event_type AS DOUBLE)) AS BIGINT) AS VARCHAR) AS unreadable
    FROM (SELECT value, event_type, CONCAT('00', event_id, '.0') AS manuscript_id FROM events) e""")
def _(t):
    text = F.concat(F.lit("00"), F.col("event_id").cast("string"), F.lit(".0"))
    return t.events.select(
        "value", fn.paper_id(F.col("value")).alias("from_number"),
        fn.paper_id(text).alias("from_text"), fn.paper_id(F.col("event_type")).alias("unreadable"))


_SPELLED = "{c}"
for _a, _b in (("ß", "ss"), ("Ä", "Ae"), ("ä", "ae"), ("Å", "Aa"), ("å", "aa"), ("Æ", "Ae"),
               ("æ", "ae"), ("Ö", "Oe"), ("ö", "oe"), ("Ø", "Oe"), ("ø", "oe"), ("Ü", "Ue"),
               ("ü", "ue"), ("Đ", "d"), ("đ", "d"), ("Ł", "l"), ("ł", "l")):
    _SPELLED = f"replace({_SPELLED}, '{_a}', '{_b}')"
_SMALL = (r"trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(" + _SPELLED +
          r"), '\s+', '-', 'g')), '[^a-z0-9._-]', '', 'g'), '-+', '-', 'g'), '-')")
ASCII = (f"array_to_string(list_transform(regexp_extract_all({_SMALL}, '[a-z]+|[^a-z]+'), "
         "lambda x: upper(x[1]) || x[2:]), '')")


@query("ascii_name", f"""
    SELECT title AS id, {ASCII.format(c='last_name')} AS name FROM raw_arrivals UNION ALL
    SELECT CAST(doc_id AS VARCHAR), {ASCII.format(c='text')} FROM documents""")
def _(t):
    names = t.raw_arrivals.select(F.col("title").alias("id"), F.col("last_name").alias("raw"))
    texts = t.documents.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("raw"))
    return names.unionByName(texts).select("id", fn.ascii_name(F.col("raw")).alias("name"))


@query("surname", """
    SELECT last_name, lower(trim(split_part(reversed, ',', 1))) AS from_last_first,
        lower(regexp_extract(trim(plain), '(\\S+)$', 1)) AS from_first_last
    FROM (SELECT last_name, concat(last_name, ', ', first_name) AS reversed,
          concat(first_name, ' ', last_name, ' ') AS plain FROM raw_arrivals) r""")
def _(t):
    reversed_ = F.concat("last_name", F.lit(", "), "first_name")
    plain = F.concat("first_name", F.lit(" "), "last_name", F.lit(" "))
    return t.raw_arrivals.select("last_name", fn.surname(reversed_).alias("from_last_first"),
                                 fn.surname(plain).alias("from_first_last"))


@query("title_tokens", f"""
    SELECT doc_id, array_to_string(list_sort({_TITLE.format(c='text')}), ' ') AS tokens FROM documents""")
def _(t):
    tokens = fn.title_tokens(F.col("text"))
    return t.documents.select("doc_id", F.array_join(F.array_sort(tokens), " ").alias("tokens"))


@query("strip_prefix", r"""
    SELECT global_id, trim(regexp_replace(name,
        '^Replication (Data|Code|Codes)( and Instructions)? for:?\s*', '', 'i'), '"“” ') AS title
    FROM datasets""")
def _(t):
    return t.datasets.select("global_id", fn.strip_prefix(F.col("name")).alias("title"))


@query("article_doi", """
    SELECT global_id, CASE WHEN citation IS NOT NULL THEN CONCAT('10.1086/', doc_id) END AS doi
    FROM datasets""")
def _(t):
    return t.datasets.select("global_id", fn.article_doi(F.col("citation")).alias("doi"))


@query("doi_from_url", "SELECT CONCAT('doi:10.1086/', doc_id) AS doi FROM documents")
def _(t):
    url = F.concat(F.lit("https://doi.org/10.1086/"), F.col("doc_id").cast("string"))
    return t.documents.select(fn.doi_from_url(url).alias("doi"))


@query("form_dates", """
    SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) AS day_of_time,
        CAST(NULL AS DATE) AS unreadable FROM events""")
def _(t):
    return t.events.select(
        "event_id", fn.form_date(F.date_format("ts", "dd/MM/yyyy")).alias("day"),
        fn.form_timestamp(F.date_format("ts", "dd/MM/yyyy H:m:s")).alias("day_of_time"),
        fn.form_date(F.col("event_type")).alias("unreadable"))


@query("date_from_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS full_date,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS no_day,
        CAST(date_trunc('year', o_orderdate) AS DATE) AS no_month FROM orders""")
def _(t):
    parts = [F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")]
    named = [fn.date_from_parts(F.array(*parts[:n])).alias(a)
             for n, a in ((3, "full_date"), (2, "no_day"), (1, "no_month"))]
    return t.orders.select("o_orderkey", *named)


@query("quarter_label", """
    SELECT paper_id, year(first_arrival_date) || '-Q' || quarter(first_arrival_date) AS quarter
    FROM papers""")
def _(t):
    return t.papers.select("paper_id", fn.quarter_label(F.col("first_arrival_date")).alias("quarter"))


@query("days_between", """
    SELECT paper_id, round, CAST(date_completed_repl - date_assigned_repl AS INT) AS days FROM iterations""")
def _(t):
    days = fn.days_between(F.col("date_assigned_repl"), F.col("date_completed_repl"))
    return t.iterations.select("paper_id", "round", days.alias("days"))


_ACTOR = """CASE {c} WHEN 'new_arrival' THEN 'Data Editor' WHEN 'with_author' THEN 'Author'
    WHEN 'author_back_de' THEN 'Data Editor' WHEN 'with_replicator' THEN 'Replicator'
    WHEN 'replicator_back_de' THEN 'Data Editor' WHEN 'acceptable_package' THEN 'Journal Office'
    WHEN 'published_package' THEN 'None (Completed)' ELSE 'Unknown' END"""


@query("responsible_actor", f"""
    SELECT paper_id, {_ACTOR.format(c='status')} AS actor FROM papers UNION ALL
    SELECT paper_id, 'Unknown' FROM uploads""")
def _(t):
    states = t.papers.select("paper_id", "status").unionByName(
        t.uploads.select("paper_id", F.col("kind").alias("status")))
    return states.select("paper_id", fn.responsible_actor(F.col("status")).alias("actor"))


@query("age_band", """
    SELECT paper_id, round, CASE WHEN d <= 3 THEN '<=3' WHEN d <= 5 THEN '<=5' WHEN d <= 10 THEN '<=10'
        WHEN d > 10 THEN '>10' END AS band
    FROM (SELECT paper_id, round, date_completed_repl - date_assigned_repl AS d FROM iterations) x""")
def _(t):
    days = fn.days_between(F.col("date_assigned_repl"), F.col("date_completed_repl"))
    return t.iterations.select("paper_id", "round", fn.age_band(days).alias("band"))


@query("os_family", """
    SELECT email, CASE WHEN os LIKE 'mac%' OR os = 'Darwin' THEN 'macOS' WHEN os LIKE 'Win%' THEN 'Windows'
        WHEN os LIKE 'Ubuntu%' THEN 'Linux' ELSE 'Other' END AS family FROM replicators""")
def _(t):
    return t.replicators.select("email", fn.os_family(F.col("os")).alias("family"))


@query("overlap", f"""
    SELECT doc_id, CASE WHEN least(len(a), len(b)) > 0 THEN
        CAST(len(list_intersect(a, b)) AS DOUBLE) / least(len(a), len(b)) END AS score
    FROM (SELECT doc_id, {_TITLE.format(c="split_part(text, chr(10), 1)")} AS a,
          {_TITLE.format(c="substr(text, length(split_part(text, chr(10), 1)) + 1)")} AS b FROM documents) x""")
def _(t):
    text, head = F.col("text"), first_line(F.col("text"))
    rest = F.substr(text, F.length(head) + 1)
    return t.documents.select(
        "doc_id", fn.overlap(fn.title_tokens(head), fn.title_tokens(rest)).alias("score"))


@query("invoice_number", """
    SELECT email, TRY_CAST(split_part(invoice, '-', 2) AS INT) AS n FROM replicators""")
def _(t):
    return t.replicators.select("email", fn.invoice_number(F.col("invoice")).alias("n"))


@query("array_access", """
    SELECT doc_id, split_part(text, ' ', 1) AS first_word, list_contains(string_split(text, ' '), 'the') AS has_the,
        CAST(len(string_split(text, ' ')) AS INT) AS n_words FROM documents""")
def _(t):
    words = F.split("text", " ")
    return t.documents.select("doc_id", fn.first_of(words).alias("first_word"),
                              fn.has(words, "the").alias("has_the"), F.size(words).alias("n_words"))


@query("content_md5", "SELECT page_id, md5(html) AS md5 FROM pages")
def _(t):
    return t.pages.select("page_id", fn.content_md5(F.col("html")).alias("md5"))


