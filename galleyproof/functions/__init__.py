from .names import ascii_name, strip_marks, title_tokens
from .scalars import (
    age_band,
    article_doi,
    case_id,
    case_path,
    clean_journal,
    content_md5,
    date_from_parts,
    days_between,
    doi_from_url,
    first_of,
    form_date,
    form_timestamp,
    has,
    invoice_number,
    is_draft,
    is_test,
    na_default,
    os_family,
    overlap,
    paper_id,
    paper_slug,
    parse_bool,
    quarter_label,
    responsible_actor,
    strip_prefix,
    surname,
    yesno_bool,
)

__all__ = [
    "age_band", "article_doi", "ascii_name", "case_id", "case_path", "clean_journal",
    "content_md5", "date_from_parts", "days_between", "doi_from_url", "first_of", "form_date",
    "form_timestamp", "has", "invoice_number", "is_draft", "is_test", "na_default", "os_family",
    "overlap", "paper_id", "paper_slug", "parse_bool", "quarter_label", "responsible_actor",
    "strip_marks", "strip_prefix", "surname", "title_tokens", "yesno_bool",
]
