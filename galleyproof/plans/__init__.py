from . import changes, ingest, linkage, packages, quality, reports, snapshots

__all__ = ["changes", "ingest", "linkage", "packages", "quality", "reports", "snapshots"]
