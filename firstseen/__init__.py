"""First-occurrence de-duplication of daily newline-delimited JSON feeds on Spark."""

from firstseen.config import DEFAULT_KEY_FIELDS, DedupConfig

__all__ = ["DEFAULT_KEY_FIELDS", "DedupConfig"]
