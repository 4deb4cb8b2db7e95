"""A game's and a player's facts from raw page strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def winner(home: Column, away: Column, home_runs: Column, away_runs: Column) -> Column:
    """Null for a tie or a missing score."""
    return F.when(home_runs > away_runs, home).when(away_runs > home_runs, away)


def loser(home: Column, away: Column, home_runs: Column, away_runs: Column) -> Column:
    return F.when(home_runs > away_runs, away).when(away_runs > home_runs, home)


def venue(text: Column) -> Column:
    """The text behind the label, without its colon."""
    return F.nullif(F.trim(F.regexp_replace(text, r"^\s*(?:Venue)?\s*:?\s*", "")), F.lit(""))


def long_date(text: Column) -> Column:
    """'Weekday, Month d, yyyy' as a date."""
    found = F.regexp_extract(text, r"([A-Z][a-z]+ \d{1,2}, \d{4})", 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("MMMM d, yyyy")).cast("date")


def start_time(text: Column) -> Column:
    """'Start Time: 7:05 p.m. Local' as '7:05 PM'."""
    found = F.regexp_extract(text, r"(?i)(\d{1,2}:\d{2}\s*[ap]\.?m\.?)", 1)
    return F.nullif(F.upper(F.replace(found, F.lit("."), F.lit(""))), F.lit(""))


def innings_played(headers: Column, cells: Column, text: Column) -> Column:
    """The largest numeric heading, else the line score's cells less 4, else 'N inning' in the text from 15 to 10, else 9."""
    largest = F.array_max(F.transform(F.filter(headers, lambda h: h.rlike(r"^\s*\d+\s*$")), lambda h: F.trim(h).cast("int")))
    counted = F.when(cells - 4 > 0, cells - 4)
    said = F.coalesce(*(F.when(F.lower(text).contains(f"{n} inning"), n) for n in range(15, 9, -1)))
    return F.coalesce(largest, counted, said, F.lit(9)).cast("int")


def is_shortened(innings: Column, text: Column) -> Column:
    return (innings < 9) | F.coalesce(F.lower(text).rlike("rain-shortened|called game|game called|suspended"), F.lit(False))


def is_extra_innings(innings: Column) -> Column:
    return innings > 9


def playoff_round(title: Column) -> Column:
    """The round a title names, null in the regular season."""
    low = F.lower(title)
    return F.when(low.contains("world series"), "World Series").when(low.rlike(r"championship series|\b[an]lcs\b"), "Championship Series").when(low.rlike(r"division series|\b[an]lds\b"), "Division Series").when(low.contains("wild card"), "Wild Card").when(low.contains("playoff") | low.contains("postseason"), "Playoffs")


def is_playoff(title: Column) -> Column:
    return playoff_round(title).isNotNull()


def height_inches(text: Column) -> Column:
    """'6-2' as 74."""
    feet, inches = (F.regexp_extract(text, r"(\d)-(\d{1,2})", i).try_cast("int") for i in (1, 2))
    return feet * 12 + inches


def weight_pounds(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d{2,3})\s*lb", 1).try_cast("int")


def hand(text: Column) -> Column:
    """R, L or S (both) of 'Right', 'Left', 'Switch' or 'Both'; null for anything else."""
    return F.when(text.rlike("(?i)right"), "R").when(text.rlike("(?i)left"), "L").when(text.rlike("(?i)switch|both"), "S")
