"""Decision rules: what may be relied on. History decides, not a status field; null stays unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def legal_state(history: DataFrame, case: str) -> DataFrame:
    """V-05: history (case, use, at, scope): use in defended, repealed, validation, trial; scope null or '*' is full.

    undetermined: a trial after the last decisive event. repealed: unless a full validation follows the last repeal. Then partial
    or final by the last validation, else active. One pre-aggregation per case.
    """
    when = lambda use, extra=F.lit(True): F.max(F.when((F.col("use") == use) & extra, F.col("at")))
    full = F.coalesce(F.col("scope"), F.lit("*")) == "*"
    per = history.groupBy(case).agg(
        when("repealed").alias("repealed"), when("validation").alias("validated"), when("validation", full).alias("full"), when("trial").alias("trial"),
        F.max(F.when(F.col("use").isin("defended", "repealed", "validation"), F.col("at"))).alias("decisive"),
        F.max(F.when(F.col("use") == "validation", F.struct("at", full.alias("is_full"))))["is_full"].alias("last_is_full"),
    )
    state = (
        F.when(F.coalesce(F.col("trial") > F.col("decisive"), F.col("trial").isNotNull()), "undetermined")
        .when(F.col("repealed").isNotNull() & ~F.coalesce(F.col("full") > F.col("repealed"), F.lit(False)), "repealed")
        .when(F.col("validated").isNotNull() & ~F.col("last_is_full"), "partial")
        .when(F.col("validated").isNotNull(), "final").otherwise("active")
    )
    return per.select(case, state.alias("state"))


def finality(marks: Column) -> Column:
    """V-06: marks: array of booleans. Contradiction is the cautious false; no mark is null."""
    marks = F.filter(marks, lambda m: m.isNotNull())
    return F.when(F.size(marks) > 0, F.forall(marks, lambda m: m))


# Comments on a ruling that do not question it.
NEUTRAL = ("potwierdzona prawomocnym wyrokiem", "nie wygasł")


def undermined(comments: Column, status: Column, neutral: str = "(?i)" + "|".join(NEUTRAL)) -> Column:
    """V-07: whether any comment is not neutral or any status is not current."""
    return F.exists(comments, lambda c: ~c.rlike(neutral)) | F.exists(status, lambda s: (s != "") & (F.lower(s) != "aktualna"))


RANKS = {"void_whole": 5, "repealed": 4, "void_part": 3, "corrected": 2, "amended": 1}


def worst_relation(relations: DataFrame, act: str, kind: Column) -> DataFrame:
    """V-08: the gravest relation of each act; only whole invalidity blocks the text."""
    rank = F.coalesce(*[F.when(kind == k, n) for k, n in RANKS.items()], F.lit(0))
    per = relations.groupBy(act).agg(F.max(rank).alias("rank"), F.count("*").alias("n"))
    name = F.coalesce(*[F.when(F.col("rank") == n, k) for k, n in RANKS.items()], F.lit("none"))
    return per.select(act, name.alias("worst"), (F.col("rank") == 5).alias("blocked"), "n")


def currency(changed: Column, effective: Column, missing: Column) -> Column:
    """V-02: of one change to one passage: changed (null: could not be read), effective already, and whether the text surely lacks it."""
    return (
        F.when(changed.isNull() & effective, "NOT_EXAMINED").when(~F.coalesce(changed, F.lit(False)), "UNCHANGED")
        .when(effective & missing, "OLD_WORDING").when(effective, "CANNOT_TELL").otherwise("FUTURE_CHANGE")
    )


def in_force(entry: Column, entries: Column, today: Column) -> Column:
    """V-03: not yet in force, partly in force (a staged entry is still to come), or in force."""
    return F.when(entry > today, "NOT_YET").when(F.exists(entries, lambda d: d > today), "PARTLY").otherwise("IN_FORCE")


def version_state(state: Column, newest: Column, has_base: Column, today: Column) -> Column:
    """V-04: of a version by its date, the newest date that is not in the future, and whether it is the base act."""
    return F.when(state > today, "FUTURE").when(has_base & newest.isNotNull(), "BASE_HAS_CONSOLIDATION").when(state < newest, "SUPERSEDED").otherwise("CURRENT")


def reasons_date(judgment: Column, portal: Column, heading: Column) -> Column:
    """V-09: what a date of written reasons is, from the portal's date and the heading's."""
    return (
        F.when(judgment < portal, "JUDGMENT").when((judgment == portal) & (heading == judgment), "BOTH")
        .when(judgment == portal, "REASONS").when(portal.isNotNull(), "UNCLEAR").otherwise("UNKNOWN")
    )


def beyond_collection(since: Column, bound: Column) -> Column:
    """V-10: a search from after the end of a closed collection proves nothing."""
    return F.when(bound.isNull(), "UNKNOWN").when(since > bound, "BEYOND").otherwise("COVERED")


def contradicts(status_open: Column, kinds: Column, ending: str) -> Column:
    """V-11: an open status though a change ended it."""
    return status_open & F.exists(kinds, lambda k: k.rlike(ending))


def failure_class(error: Column) -> Column:
    """S-04: class of a transport failure from its message."""
    e = F.lower(error)
    return (
        F.when(e.contains("proxy") | e.contains("407"), "proxy").when(e.contains("timed out") | e.contains("timeout"), "timeout")
        .when(e.contains("name or service") | e.contains("unreachable") | e.contains("getaddrinfo"), "no network")
        .when(e.rlike(r"\b5\d\d\b") | e.contains("refused"), "server").otherwise("other")
    )
