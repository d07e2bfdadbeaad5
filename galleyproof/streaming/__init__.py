from .forms import ingest_forms
from .uploads import apply_arrivals, record_arrivals

__all__ = ["apply_arrivals", "ingest_forms", "record_arrivals"]
