"""The movie-table compositions: cleaning (X1), analysis base (X2), Q1-Q5 (X3-X7), profile.

Column names follow the reference's movie table: movie_id, title, year, rating_score,
rating_count, genres, countries, directors, collect_count, summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import explode_labels, retype, safe_cast
from ..operators.cleaning import (Rule, Step, any_rule, apply_steps, cleaning_audit, fill_missing, land_audited, present,
                                  range_predicate)
from ..operators.profile import bucket_counts, label_counts, missing_profile, numeric_summary, profile_table, row_count
from ..operators.ranking import top_per_label
from ..operators.reports import group_report, top_k, trend
from ..sources.io import land_parquet, preview, schema_report

# Fixed values of the reference's cleaning and analysis scripts.
SUMMARY_DEFAULT = "暂无简介"  # fill text for a missing summary ("no summary yet")
MIN_YEAR = 1900
MIN_SCORE = 1.0
CLEAN_TYPES = {"year": "float", "rating_score": "float", "rating_count": "bigint", "collect_count": "bigint"}
NUMERIC_COLS = ["year", "rating_score", "rating_count", "collect_count"]
COUNTRY_MIN, COUNTRY_TOP = 5, 15
DIRECTOR_MIN, DIRECTOR_TOP = 3, 20
GENRE_TOP = 3
HIGH_TOP = 15
# Q5 rules: (country text, score strictly above, raters strictly above). The thresholds are the
# original ones; the country texts are those of the titles view ('US', 'CN').
HIGH_RULES = (("US", 8.5, 100000), ("CN", 8.0, 50000))

STANDARD_MEANS = {"avg_rating": ("rating_score", 2), "avg_rating_count": ("rating_count", 0)}


def clean_steps() -> list[Step]:
    """X1 rules in the reference's order, on the retyped table."""
    return [
        Step("year present", F.col("year").isNotNull()),
        Step("rating_score >= 1", range_predicate("rating_score", lo=MIN_SCORE)),
        Step("year >= 1900", range_predicate("year", lo=MIN_YEAR)),
    ]


def clean_movies(raw: DataFrame, summary_default: str = SUMMARY_DEFAULT) -> DataFrame:
    """Retype -> drop NULL year -> fill NULL summary -> score >= 1 -> year >= 1900."""
    typed = retype(raw, CLEAN_TYPES)
    return fill_missing(apply_steps(typed, clean_steps()), {"summary": summary_default})


def clean_audit(raw: DataFrame) -> DataFrame:
    """A10 over X1: rows in / removed by rule / removed as NULL / out, per step, in one pass."""
    return cleaning_audit(retype(raw, CLEAN_TYPES), clean_steps())


def land_clean_movies(raw: DataFrame, path: str, summary_default: str = SUMMARY_DEFAULT) -> DataFrame:
    """X1 + A10 in one scan: land the clean table as Parquet under ``path`` and return the audit of the same job."""
    return land_audited(retype(raw, CLEAN_TYPES), clean_steps(), lambda clean: land_parquet(clean, path),
                        lambda kept: fill_missing(kept, {"summary": summary_default}))


def analysis_base(raw: DataFrame) -> DataFrame:
    """The filter every analysis query inherits. Inferred types: year, scores and counts may be text;
    text that is no number becomes NULL (and a NULL score drops the row), typed columns stay as they are."""
    numeric = [c for c in ("rating_score", "rating_count", "collect_count") if c in raw.columns]
    raw = raw.withColumns({c: safe_cast(c, "double") for c in numeric if isinstance(raw.schema[c].dataType, StringType)})
    year = safe_cast("year", "double")
    return raw.filter(range_predicate(year, lo=MIN_YEAR) & range_predicate("rating_score", lo=MIN_SCORE)
                      & present("countries"))


def country_report(base: DataFrame, k: int = COUNTRY_TOP, min_count: int = COUNTRY_MIN,
                   trim: bool = False) -> DataFrame:
    """Per country label: movies, mean score (2 places), mean raters (bigint); >= 5; top 15.
    ``trim=True`` merges ' FR' and 'FR' (the single-machine variant's labels)."""
    exploded = explode_labels(base.select("countries", "rating_score", "rating_count"), "countries", "country",
                              trim=trim)
    return group_report(exploded, "country", "movie_count", STANDARD_MEANS, min_count=min_count,
                        order=[F.col("movie_count").desc()], k=k)


def director_board(base: DataFrame, k: int = DIRECTOR_TOP, min_count: int = DIRECTOR_MIN) -> DataFrame:
    """Per whole director string (NULL and '' are groups): >= 3 movies, by rounded mean
    score then count, top 20."""
    return group_report(base, "directors", "movie_count", STANDARD_MEANS, min_count=min_count,
                        order=[F.col("avg_rating").desc(), F.col("movie_count").desc()], k=k)


def decade_trend(base: DataFrame) -> DataFrame:
    """Per decade (int): count, mean score (2), mean raters (0), mean saves (0)."""
    decade = (F.floor(safe_cast("year", "double") / F.lit(10)) * F.lit(10)).cast("int")
    means = dict(STANDARD_MEANS, avg_collect_count=("collect_count", 0))
    return trend(base, decade, "decade", "movie_count", means)


def top_per_genre(base: DataFrame, k: int = GENRE_TOP, method: str = "dense_rank",
                  trim: bool = False) -> DataFrame:
    """Explode genres, rank by score desc then raters desc inside each genre, keep <= 3;
    ordered by genre, rank, title."""
    exploded = explode_labels(base.select("genres", "title", "rating_score", "rating_count", "year"),
                              "genres", "genre", trim=trim)
    ranked = top_per_label(exploded, "genre", [("rating_score", "desc"), ("rating_count", "desc")],
                           k, method, "rank_in_genre")
    return (ranked.select("genre", "title", "rating_score", "rating_count", "year", "rank_in_genre")
            .orderBy(F.col("genre").asc_nulls_first(), "rank_in_genre", "title"))


def two_region_high(base: DataFrame, rules=HIGH_RULES, k: int = HIGH_TOP) -> DataFrame:
    """Rows matching either region rule (once), top 15 by score, title as tie-break."""
    matched = any_rule(base, [Rule("countries", text, (("rating_score", s), ("rating_count", n)))
                              for text, s, n in rules])
    picked = matched.select("title", "rating_score", "rating_count", "countries", "year")
    return top_k(picked, [F.col("rating_score").desc()], k, tiebreak=["title"])


def profile_report(raw: DataFrame, key: str = "movie_id") -> dict[str, DataFrame]:
    """Schema, ordered preview, row counts, missing profile, numeric summary, label and decade counts.

    ``table`` is the one-scan form of the raw table's profile (D1 + D2 + D3 together)."""
    cleaned = clean_movies(raw)
    return {
        "table": profile_table(raw),
        "schema": schema_report(raw),
        "preview": preview(raw, 5, 50, order_by=[key]),
        "rows_before": row_count(raw),
        "rows_after": row_count(cleaned),
        "missing": missing_profile(raw),
        "numeric": numeric_summary(cleaned, NUMERIC_COLS),
        "genres_top": label_counts(cleaned, "genres", "/", k=10, out="genre"),
        "decades": bucket_counts(cleaned, "year", 10, out="decade"),
    }
