"""The record key: SHA-256 over the effective table and the key fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from firstseen.config import DedupConfig
from firstseen.functions.lines import NULL_TEXT, path_text

# Fixed value: the byte that ends every part of the key text.
PART_END = "\x1f"


def key_text(
    line: Column,
    table: Column,
    fields: Sequence[str],
    extracted: Mapping[str, Column] | None = None,
) -> Column:
    """Table, then path and value of each field, every part ended by 0x1F.

    ``extracted`` holds value texts already at hand, to save parsing again.
    """
    known = extracted or {}
    parts = [table, F.lit(PART_END)]
    for dotted in fields:
        text = known[dotted] if dotted in known else path_text(line, dotted)
        parts += [F.lit(dotted + PART_END), F.coalesce(text, F.lit(NULL_TEXT)), F.lit(PART_END)]
    return F.concat(*parts)


def field_choice(table: Column, config: DedupConfig) -> list[tuple[Column | None, tuple[str, ...]]]:
    """(condition, fields) pairs in order; the last one has no condition.

    Tables that share a field list share a branch, and an override equal to the
    global list needs none.
    """
    by_fields: dict[tuple[str, ...], list[str]] = {}
    for name, fields in config.table_key_fields.items():
        by_fields.setdefault(tuple(fields), []).append(name)
    default = tuple(config.key_fields)
    by_fields.pop(default, None)
    subject = F.lower(table) if config.case_insensitive_overrides else table
    choice: list[tuple[Column | None, tuple[str, ...]]] = []
    for fields, names in by_fields.items():
        if config.case_insensitive_overrides:
            names = [name.lower() for name in names]
        choice.append((subject.isin(*names), fields))
    return [*choice, (None, default)]


def _choose(table: Column, config: DedupConfig, value) -> Column:
    *overrides, (_, default) = field_choice(table, config)
    if not overrides:
        return value(default)
    chosen = F.when(overrides[0][0], value(overrides[0][1]))
    for condition, fields in overrides[1:]:
        chosen = chosen.when(condition, value(fields))
    return chosen.otherwise(value(default))


def key_fields(table: Column, config: DedupConfig) -> Column:
    """The comma-separated key fields that apply to a table."""
    return _choose(table, config, lambda fields: F.lit(",".join(fields)))


def dedup_key(
    line: Column,
    table: Column,
    config: DedupConfig,
    extracted: Mapping[str, Column] | None = None,
) -> Column:
    """The 32 key bytes. Binary halves what a hex string would add to a shuffle."""
    text = _choose(table, config, lambda fields: key_text(line, table, fields, extracted))
    return F.unhex(F.sha2(text, 256))


def all_fields(config: DedupConfig) -> list[str]:
    """Every path any table's key may read, each once."""
    paths = [*config.key_fields]
    for fields in config.table_key_fields.values():
        paths += fields
    return list(dict.fromkeys(paths))


def key_hex(key: Column) -> Column:
    return F.lower(F.hex(key))
