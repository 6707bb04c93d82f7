"""Reading feeds and published files; generating test feeds."""
