"""Column groups shared by every stage of the job.

An *envelope* row is one physical line of one file. Its columns are

==============  =======  ==================================================
role            STRING   ``PRIOR`` (already published) or ``TODAY`` (raw feed)
role_rank       INT      0 for PRIOR, 1 for TODAY, so the baseline sorts first
table_name      STRING   table of the file, case as written
file_date       DATE     business date of the file
sequence        INT      number of the file within its table and date
file_path       STRING   full path: the identity of a file
file_name       STRING   last part of the path
line_no         BIGINT   1-based physical line number
raw_line        STRING   the line, never re-serialised
==============  =======  ==================================================

A *prepared* row adds ``line_kind`` (blank, reject, record), ``reason``,
``effective_table``, ``scope_table`` and ``dedup_key``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIOR, TODAY = "PRIOR", "TODAY"

ENVELOPE = [
    "role",
    "role_rank",
    "table_name",
    "file_date",
    "sequence",
    "file_path",
    "file_name",
    "line_no",
    "raw_line",
]

# Two records are copies of each other when these three agree. The key leads
# because sorts compare the first eight bytes of the first column: hash bytes
# decide almost every comparison there, table names would not.
GROUP = ["dedup_key", "scope_table", "file_date"]

# Arrival order: published records first, then sequence, path, line.
POSITION = ["role_rank", "sequence", "file_path", "line_no"]


def position() -> Column:
    """The arrival position of a row as a comparable struct."""
    return F.struct(*POSITION)


def role_rank(role: Column) -> Column:
    return F.when(role == PRIOR, 0).otherwise(1)
