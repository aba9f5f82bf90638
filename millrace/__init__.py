"""millrace: tabular studies on Spark, from raw files to scored models."""

from millrace.session import build_session, open_tables, shared_dir, written

__all__ = ["build_session", "open_tables", "shared_dir", "written"]
