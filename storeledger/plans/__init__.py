"""Whole builds: bronze to silver to gold, capture runs, crosswalk files."""
