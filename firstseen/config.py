"""Settings of a run, checked once when they are built."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# The default key of a record, in this order.
DEFAULT_KEY_FIELDS = (
    "ChangeData.id",
    "Source.Table",
    "ChangeData.ChangeDateTime",
    "Data._creationdate",
)

# Fixed value: more malformed lines than this in one published file fail a run.
PRIOR_REJECT_LIMIT = 1000

# Space and all control characters below it: what is trimmed from a table name.
CONTROLS = "".join(map(chr, range(33)))

# A hot key takes a key, a scope and a position; with long paths up to 2 KB.
MAX_HOT_KEYS = 100_000


def path_segments(dotted: str) -> list[str]:
    """Split a dotted path; trailing empty segments are dropped."""
    segments = dotted.split(".")
    while segments and segments[-1] == "":
        segments.pop()
    if not segments or "" in segments:
        raise ValueError(f"empty segment in key path {dotted!r}")
    for segment in segments:
        if segment == "*" or "'" in segment or "?" in segment:
            raise ValueError(f"segment {segment!r} of key path {dotted!r} cannot be addressed")
    return segments


def normalise_tables(names: Sequence[str]) -> list[str]:
    """Trimmed, lower-cased, distinct, in order."""
    kept: dict[str, None] = {}
    for name in names:
        text = (name or "").strip(CONTROLS).lower()
        if text:
            kept.setdefault(text)
    if not kept:
        raise ValueError("the list of allowed tables is empty")
    return list(kept)


@dataclass(frozen=True)
class DedupConfig:
    """What makes two records equal, and how a run treats its files.

    ``table_key_fields`` overrides ``key_fields`` by effective table. The lookup
    is case-sensitive unless ``case_insensitive_overrides`` is set.
    ``publish_mode`` is ``merge`` (new survivors join what is published) or
    ``replace`` (they take its place). ``single_file`` asks for one output file
    per table and date, whatever its size; ordered part files are the way to scale.
    ``hot_keys`` bounds a broadcast and has a bound itself. ``keep_baseline`` keeps
    the keys of published files beside them, so that a run reads each file once only,
    in ``baseline_buckets`` parts a date: enough that a task can sort one.
    """

    key_fields: Sequence[str] = DEFAULT_KEY_FIELDS
    table_key_fields: Mapping[str, Sequence[str]] = field(default_factory=dict)
    case_insensitive_overrides: bool = False
    tables: Sequence[str] = ()
    tables_file: str | None = None
    run_dates: Sequence[dt.date] = ()
    run_id: str = ""
    skip_malformed: bool = True
    prior_reject_limit: int = PRIOR_REJECT_LIMIT
    publish_mode: str = "merge"
    single_file: bool = False
    hot_min_copies: int = 100_000
    hot_keys: int = 20_000
    keep_baseline: bool = False
    baseline_buckets: int = 64

    def __post_init__(self) -> None:
        if not self.key_fields:
            raise ValueError("key_fields is empty")
        for fields in (self.key_fields, *self.table_key_fields.values()):
            for dotted in fields:
                path_segments(dotted)
        if not 0 <= self.hot_keys <= MAX_HOT_KEYS:
            raise ValueError(f"hot_keys is not between 0 and {MAX_HOT_KEYS}")
        if self.baseline_buckets < 1:
            raise ValueError("baseline_buckets is less than 1")
        if self.hot_min_copies < 1:
            raise ValueError("hot_min_copies is less than 1")
        if self.publish_mode not in ("merge", "replace"):
            raise ValueError(f"unknown publish mode {self.publish_mode!r}")
        if self.tables:
            normalise_tables(self.tables)
