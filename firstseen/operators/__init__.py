"""The relational core: prepare lines, find first occurrences, count."""
