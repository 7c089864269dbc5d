"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder takes (spark, sf_dir) and reads the driver tables (or views derived from them by
SQL), so its work grows with the data. The oracle SQL is plain SQL over the same tables, run by an
independent engine (DuckDB); computed columns carry the same aliases on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import explode_labels, round_to
from ..operators import profile, reports, words
from ..operators.overlap import label_overlaps, region_overlap
from ..session import scratch_path
from . import movies
from .views import MESSY_EVENTS_SQL, TITLES_SQL, messy_events, table, titles

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, oracle: str | None):
    def wrap(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle)
        return fn
    return wrap


# --- oracle SQL helpers: the same rounding route as functions.columns.round_to / round_long ---
def R(expr: str, places: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def RL(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), 0) AS BIGINT)"


def with_titles(body: str) -> str:
    return f"WITH titles AS ({TITLES_SQL})\n{body}"


BASE_SQL = """base AS (SELECT * FROM titles WHERE try_cast(year AS DOUBLE) >= 1900
  AND rating_score >= 1.0 AND NOT isnan(rating_score) AND countries IS NOT NULL AND countries <> '')"""


def with_base(body: str) -> str:
    return f"WITH titles AS ({TITLES_SQL}), {BASE_SQL}\n{body}"


# ----------------------------------------------------------------------------- movie analysis
@query("country_report", with_base(f"""
SELECT country, count(*) AS movie_count, {R('avg(rating_score)', 2)} AS avg_rating,
       {RL('avg(rating_count)')} AS avg_rating_count
FROM (SELECT unnest(string_split(countries, '/')) AS country, rating_score, rating_count FROM base) x
GROUP BY country HAVING count(*) >= 5
ORDER BY movie_count DESC, country ASC NULLS FIRST LIMIT 15"""))
def q_country_report(spark, sf):
    return movies.country_report(movies.analysis_base(titles(spark, sf)))


@query("director_board", with_base(f"""
SELECT directors, count(*) AS movie_count, {R('avg(rating_score)', 2)} AS avg_rating,
       {RL('avg(rating_count)')} AS avg_rating_count
FROM base GROUP BY directors HAVING count(*) >= 3
ORDER BY avg_rating DESC, movie_count DESC, directors ASC NULLS FIRST LIMIT 20"""))
def q_director_board(spark, sf):
    return movies.director_board(movies.analysis_base(titles(spark, sf)))


@query("decade_trend", with_base(f"""
SELECT CAST(floor(try_cast(year AS DOUBLE) / 10) * 10 AS INTEGER) AS "decade", count(*) AS movie_count,
       {R('avg(rating_score)', 2)} AS avg_rating, {RL('avg(rating_count)')} AS avg_rating_count,
       {RL('avg(collect_count)')} AS avg_collect_count
FROM base GROUP BY 1"""))
def q_decade_trend(spark, sf):
    return movies.decade_trend(movies.analysis_base(titles(spark, sf)))


@query("top_per_genre", with_base("""
SELECT genre, title, rating_score, rating_count, year, rank_in_genre FROM (
  SELECT genre, title, rating_score, rating_count, year,
         CAST(dense_rank() OVER (PARTITION BY genre ORDER BY rating_score DESC, rating_count DESC) AS INTEGER) AS rank_in_genre
  FROM (SELECT unnest(string_split(genres, '/')) AS genre, title, rating_score, rating_count, year FROM base) x
) r WHERE rank_in_genre <= 3"""))
def q_top_per_genre(spark, sf):
    return movies.top_per_genre(movies.analysis_base(titles(spark, sf)))


@query("rank_variants_genre", with_base("""
SELECT genre, title, rating_score, rating_count, rank_in_genre FROM (
  SELECT genre, title, rating_score, rating_count,
         CAST(rank() OVER (PARTITION BY genre ORDER BY rating_score DESC) AS INTEGER) AS rank_in_genre
  FROM (SELECT unnest(string_split(genres, '/')) AS genre, title, rating_score, rating_count FROM base) x
) r WHERE rank_in_genre <= 2"""))
def q_rank_variants(spark, sf):
    """``rank`` variant (ties share a rank and leave gaps). The key is the score alone (about
    100 values), so ties are massive at scale: the aggregation of distinct keys collapses them."""
    from ..functions.columns import explode_labels
    from ..operators.ranking import top_per_label
    base = movies.analysis_base(titles(spark, sf)).select("genres", "title", "rating_score", "rating_count")
    ex = explode_labels(base, "genres", "genre")
    return top_per_label(ex, "genre", [("rating_score", "desc")], 2, "rank", "rank_in_genre") \
        .select("genre", "title", "rating_score", "rating_count", "rank_in_genre")


@query("row_number_genre", with_base("""
SELECT genre, title, rating_score, rank_in_genre FROM (
  SELECT genre, title, rating_score,
         CAST(row_number() OVER (PARTITION BY genre ORDER BY rating_score DESC, movie_id ASC) AS INTEGER) AS rank_in_genre
  FROM (SELECT unnest(string_split(genres, '/')) AS genre, movie_id, title, rating_score FROM base) x
) r WHERE rank_in_genre <= 5"""))
def q_row_number_genre(spark, sf):
    """``row_number`` variant with a unique last sort key (exactly k rows per genre)."""
    from ..functions.columns import explode_labels
    from ..operators.ranking import top_per_label
    base = movies.analysis_base(titles(spark, sf)).select("genres", "movie_id", "title", "rating_score")
    ex = explode_labels(base, "genres", "genre")
    return top_per_label(ex, "genre", [F.col("rating_score").desc(), F.col("movie_id").asc()], 5,
                         "row_number", "rank_in_genre").select("genre", "title", "rating_score", "rank_in_genre")


@query("two_region_high", with_base("""
SELECT title, rating_score, rating_count, countries, year FROM base
WHERE (contains(countries, 'US') AND rating_score > 8.5 AND rating_count > 100000)
   OR (contains(countries, 'CN') AND rating_score > 8.0 AND rating_count > 50000)
ORDER BY rating_score DESC, title ASC LIMIT 15"""))
def q_two_region_high(spark, sf):
    return movies.two_region_high(movies.analysis_base(titles(spark, sf)))


@query("region_overlap", with_base("""
SELECT movie_id, CASE WHEN bool_or(l = 'US') AND bool_or(l = 'CN') THEN 'both'
                      WHEN bool_or(l = 'US') THEN 'a_only' ELSE 'b_only' END AS side
FROM (SELECT movie_id, unnest(string_split(countries, '/')) AS l FROM base) x
GROUP BY movie_id HAVING bool_or(l = 'US') OR bool_or(l = 'CN')"""))
def q_region_overlap(spark, sf):
    # movie_id is the key of the movie table (one row per movie), so no shuffle is needed
    return region_overlap(movies.analysis_base(titles(spark, sf)), "movie_id", "countries", "US", "CN",
                          ids_unique=True)


@query("label_overlaps_titles", with_titles("""
, l AS (SELECT DISTINCT movie_id, label FROM (SELECT movie_id, unnest(string_split(countries, '/')) AS label FROM titles
                                              UNION ALL SELECT movie_id, unnest(string_split(genres, '/')) AS label FROM titles) x),
n AS (SELECT label, count(*) AS n FROM l GROUP BY label)
SELECT a.label AS label_a, b.label AS label_b, count(*) AS n_both, any_value(na.n) AS n_a, any_value(nb.n) AS n_b
FROM l a JOIN l b ON a.movie_id = b.movie_id AND a.label < b.label JOIN n na ON na.label = a.label JOIN n nb ON nb.label = b.label
GROUP BY a.label, b.label"""))
def q_label_overlaps(spark, sf):
    """J1 for all pairs of country and genre labels."""
    t = titles(spark, sf)
    rows = explode_labels(t.select("movie_id", "countries"), "countries", "label").select("movie_id", "label").union(
        explode_labels(t.select("movie_id", "genres"), "genres", "label").select("movie_id", "label"))
    return label_overlaps(rows, "movie_id", "label")


# ----------------------------------------------------------------------------- cleaning
AUDIT_SQL = with_titles("""
, typed AS (SELECT try_cast(year AS FLOAT) AS y, CAST(rating_score AS FLOAT) AS s FROM titles)
SELECT 1 AS step_no, 'year present' AS step, count(*) AS n_in, CAST(count_if(y IS NULL) AS BIGINT) AS n_rule,
       CAST(0 AS BIGINT) AS n_null, CAST(count_if(y IS NOT NULL) AS BIGINT) AS n_out FROM typed
UNION ALL
SELECT 2, 'rating_score >= 1', count(*), CAST(count_if(s < 1 OR isnan(s)) AS BIGINT), CAST(count_if(s IS NULL) AS BIGINT),
       CAST(count_if(s >= 1 AND NOT isnan(s)) AS BIGINT) FROM typed WHERE y IS NOT NULL
UNION ALL
SELECT 3, 'year >= 1900', count(*), CAST(count_if(y < 1900 OR isnan(y)) AS BIGINT), CAST(count_if(y IS NULL) AS BIGINT),
       CAST(count_if(y >= 1900 AND NOT isnan(y)) AS BIGINT) FROM typed
WHERE y IS NOT NULL AND s >= 1 AND NOT isnan(s)""")


@query("cleaning_audit_titles", AUDIT_SQL)
def q_cleaning_audit(spark, sf):
    return movies.clean_audit(titles(spark, sf))


CLEAN_SQL = with_titles(f"""
, typed AS (SELECT movie_id, title, try_cast(year AS FLOAT) AS year, CAST(rating_score AS FLOAT) AS rating_score,
    rating_count, genres, countries, directors, collect_count,
    coalesce(summary, '{movies.SUMMARY_DEFAULT}') AS summary FROM titles)
SELECT * FROM typed WHERE year IS NOT NULL AND rating_score >= 1 AND NOT isnan(rating_score)
  AND year >= 1900 AND NOT isnan(year)""")


@query("clean_titles", CLEAN_SQL)
def q_clean_titles(spark, sf):
    return movies.clean_movies(titles(spark, sf))


@query("landed_audit_titles", AUDIT_SQL)
def q_landed_audit(spark, sf):
    """A10 + X1: the audit counted by the job that lands the clean table."""
    return movies.land_clean_movies(titles(spark, sf), f"{scratch_path(spark, 'landed_clean')}/parquet")


@query("landed_clean_titles", CLEAN_SQL)
def q_landed_clean(spark, sf):
    """A10 + X1: the clean table as the audited job landed it."""
    path = f"{scratch_path(spark, 'landed_clean')}/parquet"
    movies.land_clean_movies(titles(spark, sf), path)
    return spark.read.parquet(path)


@query("missing_profile_titles", with_titles(" UNION ALL ".join(
    f"""SELECT {i + 1} AS position, '{c}' AS column_name, CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing,
  CAST(CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing FROM titles"""
    for i, c in enumerate(["movie_id", "title", "year", "rating_score", "rating_count", "genres", "countries",
                           "directors", "collect_count", "summary"]))))
def q_missing_titles(spark, sf):
    return profile.missing_profile(titles(spark, sf))


@query("missing_profile_events", f"WITH messy AS ({MESSY_EVENTS_SQL})\n" + " UNION ALL ".join(
    f"""SELECT {i + 1} AS position, '{c}' AS column_name, CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing,
  CAST(CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing FROM messy"""
    for i, c in enumerate(["event_id", "ts", "user_id", "event_type", "value", "props"])))
def q_missing_events(spark, sf):
    return profile.missing_profile(messy_events(spark, sf))


@query("fill_summary_titles", with_titles(f"""
SELECT movie_id, coalesce(summary, '{movies.SUMMARY_DEFAULT}') AS summary,
       CASE WHEN summary IS NULL OR summary IN ('', 'null') THEN '{movies.SUMMARY_DEFAULT}' ELSE summary END AS summary_all
FROM titles"""))
def q_fill_summary(spark, sf):
    from ..operators.cleaning import fill_missing
    t = titles(spark, sf).select("movie_id", "summary")
    t = t.withColumn("summary_all", F.col("summary"))
    t = fill_missing(t, {"summary": movies.SUMMARY_DEFAULT})
    return fill_missing(t, {"summary_all": movies.SUMMARY_DEFAULT}, normalise_sentinels=True)


# ----------------------------------------------------------------------------- profile
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_summary_lineitem", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, {R(f'avg({c})', 4)} AS mean, {R(f'stddev_samp({c})', 4)} AS stddev,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in LINEITEM_NUMERIC))
def q_numeric_summary(spark, sf):
    s = profile.numeric_summary(table(spark, sf, "lineitem"), LINEITEM_NUMERIC)
    return s.select("column_name", "n", round_to("mean", 4).alias("mean"), round_to("stddev", 4).alias("stddev"),
                    "min", "max")


@query("numeric_summary_titles", with_titles("""
, typed AS (SELECT try_cast(year AS FLOAT) AS year, CAST(rating_score AS FLOAT) AS rating_score,
    rating_count, collect_count, summary FROM titles),
clean AS (SELECT * FROM typed WHERE year IS NOT NULL AND rating_score >= 1 AND NOT isnan(rating_score)
  AND year >= 1900 AND NOT isnan(year))
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, {R(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean,
  {R(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM clean"""
    for c in movies.NUMERIC_COLS)))
def q_numeric_titles(spark, sf):
    s = profile.numeric_summary(movies.clean_movies(titles(spark, sf)), movies.NUMERIC_COLS)
    return s.select("column_name", "n", round_to("mean", 4).alias("mean"), round_to("stddev", 4).alias("stddev"),
                    "min", "max")


@query("profile_orders", f"""
SELECT 1 AS position, 'o_orderkey' AS column_name, count(*) AS n_rows, CAST(count_if(o_orderkey IS NULL OR CAST(o_orderkey AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_orderkey IS NULL OR CAST(o_orderkey AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, count(o_orderkey) AS n, {R('avg(CAST(o_orderkey AS DOUBLE))', 4)} AS mean, {R('stddev_samp(CAST(o_orderkey AS DOUBLE))', 4)} AS stddev, CAST(min(o_orderkey) AS DOUBLE) AS min, CAST(max(o_orderkey) AS DOUBLE) AS max FROM orders
 UNION ALL SELECT 2 AS position, 'o_custkey' AS column_name, count(*) AS n_rows, CAST(count_if(o_custkey IS NULL OR CAST(o_custkey AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_custkey IS NULL OR CAST(o_custkey AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, count(o_custkey) AS n, {R('avg(CAST(o_custkey AS DOUBLE))', 4)} AS mean, {R('stddev_samp(CAST(o_custkey AS DOUBLE))', 4)} AS stddev, CAST(min(o_custkey) AS DOUBLE) AS min, CAST(max(o_custkey) AS DOUBLE) AS max FROM orders
 UNION ALL SELECT 3 AS position, 'o_orderstatus' AS column_name, count(*) AS n_rows, CAST(count_if(o_orderstatus IS NULL OR CAST(o_orderstatus AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_orderstatus IS NULL OR CAST(o_orderstatus AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM orders
 UNION ALL SELECT 4 AS position, 'o_totalprice' AS column_name, count(*) AS n_rows, CAST(count_if(o_totalprice IS NULL OR CAST(o_totalprice AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_totalprice IS NULL OR CAST(o_totalprice AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, count(o_totalprice) AS n, {R('avg(CAST(o_totalprice AS DOUBLE))', 4)} AS mean, {R('stddev_samp(CAST(o_totalprice AS DOUBLE))', 4)} AS stddev, CAST(min(o_totalprice) AS DOUBLE) AS min, CAST(max(o_totalprice) AS DOUBLE) AS max FROM orders
 UNION ALL SELECT 5 AS position, 'o_orderdate' AS column_name, count(*) AS n_rows, CAST(count_if(o_orderdate IS NULL OR CAST(o_orderdate AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_orderdate IS NULL OR CAST(o_orderdate AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM orders
 UNION ALL SELECT 6 AS position, 'o_orderpriority' AS column_name, count(*) AS n_rows, CAST(count_if(o_orderpriority IS NULL OR CAST(o_orderpriority AS VARCHAR) IN ('', 'null')) AS BIGINT) AS n_missing, CAST(CAST(count_if(o_orderpriority IS NULL OR CAST(o_orderpriority AS VARCHAR) IN ('', 'null')) AS BIGINT) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_missing, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM orders""")
def q_profile_orders(spark, sf):
    """D1 + D2 + D3 in one scan of orders (rounded means / stddevs for the comparison)."""
    p = profile.profile_table(table(spark, sf, "orders"))
    return p.select("position", "column_name", "n_rows", "n_missing", "pct_missing", "n",
                    round_to("mean", 4).alias("mean"), round_to("stddev", 4).alias("stddev"), "min", "max")


@query("row_count_lineitem", "SELECT count(*) AS n_rows FROM lineitem")
def q_row_count(spark, sf):
    return profile.row_count(table(spark, sf, "lineitem"))


@query("label_counts_pages", """
SELECT label, count(*) AS n FROM (SELECT unnest(string_split(url, '/')) AS label FROM pages) x GROUP BY label""")
def q_label_counts_pages(spark, sf):
    return profile.label_counts(table(spark, sf, "pages"), "url", "/")


@query("label_counts_trimmed", with_titles("""
SELECT label, count(*) AS n FROM (SELECT trim(unnest(string_split(countries, '/'))) AS label FROM titles) x
GROUP BY label"""))
def q_label_counts_trimmed(spark, sf):
    return profile.label_counts(titles(spark, sf), "countries", "/", trim=True)


@query("top_genres_clean", CLEAN_SQL.replace("SELECT * FROM typed WHERE", "SELECT genre, count(*) AS n FROM "
       "(SELECT unnest(string_split(genres, '/')) AS genre FROM typed WHERE", 1)
       + ") x GROUP BY genre ORDER BY n DESC, genre ASC NULLS FIRST LIMIT 10")
def q_top_genres(spark, sf):
    return profile.label_counts(movies.clean_movies(titles(spark, sf)), "genres", "/", k=10, out="genre")


@query("bucket_counts_year", CLEAN_SQL.replace("SELECT * FROM typed WHERE",
       "SELECT CAST(floor(year / 10) * 10 AS BIGINT) AS bucket_start, count(*) AS n FROM typed WHERE", 1)
       + " GROUP BY 1")
def q_bucket_counts_year(spark, sf):
    return profile.bucket_counts(movies.clean_movies(titles(spark, sf)), "year", 10)


@query("bucket_counts_price", """
SELECT CAST(floor(o_totalprice / 50000) * 50000 AS BIGINT) AS bucket_start, count(*) AS n FROM orders GROUP BY 1""")
def q_bucket_counts_price(spark, sf):
    return profile.bucket_counts(table(spark, sf, "orders"), "o_totalprice", 50000)


# ----------------------------------------------------------------------------- words
WS = ("[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
      "\\x{202f}\\x{205f}\\x{3000}]+")


def _word_sql(tbl: str, col: str) -> str:
    return (f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array({col}, '{WS}')) AS word "
            f"FROM {tbl}) x WHERE word <> '' GROUP BY word")


@query("word_count_top", _word_sql("documents", "text") + " ORDER BY n DESC, word ASC LIMIT 10")
def q_word_top(spark, sf):
    return words.word_count(table(spark, sf, "documents"), "text", k=10)


@query("word_top_threshold", _word_sql("documents", "text") + " ORDER BY n DESC, word ASC LIMIT 10")
def q_word_top_threshold(spark, sf):
    """O4 by thresholds: the same ten words, with next to nothing of the vocabulary shuffled."""
    return words.top_words(table(spark, sf, "documents"), "text", 10)[0]


@query("word_count_all", _word_sql("documents", "text"))
def q_word_all(spark, sf):
    return words.word_count(table(spark, sf, "documents"), "text")


@query("word_count_conversations", _word_sql("conversations", "text"))
def q_word_conv(spark, sf):
    return words.word_count(table(spark, sf, "conversations"), "text")


# ----------------------------------------------------------------------------- reports on TPC-H-ish tables
@query("flag_report_lineitem", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(l_discount) AS n_discount,
       {R('avg(l_quantity)', 4)} AS avg_qty, {R('avg(l_extendedprice)', 4)} AS avg_price,
       {R('avg(l_discount)', 6)} AS avg_disc
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_flag_report(spark, sf):
    means = {"avg_qty": ("l_quantity", 4), "avg_price": ("l_extendedprice", 4), "avg_disc": ("l_discount", 6)}
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        *reports.measures("n", means), *reports.measures("n_discount", count_col="l_discount"))


@query("trend_year_orders", f"""
SELECT date_trunc('year', o_orderdate) AS period, count(*) AS n, {R('avg(o_totalprice)', 2)} AS avg_price
FROM orders GROUP BY 1""")
def q_trend_year(spark, sf):
    return reports.trend_by_time(table(spark, sf, "orders"), "o_orderdate", "year", "n",
                                 {"avg_price": ("o_totalprice", 2)})


@query("trend_month_orders", f"""
SELECT date_trunc('month', o_orderdate) AS period, count(*) AS n, {R('avg(o_totalprice)', 2)} AS avg_price
FROM orders GROUP BY 1""")
def q_trend_month(spark, sf):
    return reports.trend_by_time(table(spark, sf, "orders"), "o_orderdate", "month", "n",
                                 {"avg_price": ("o_totalprice", 2)})


@query("trend_delta_orders", """
SELECT period, n, n - lag(n) OVER (ORDER BY period) AS delta FROM (
  SELECT date_trunc('year', o_orderdate) AS period, count(*) AS n FROM orders GROUP BY 1) t""")
def q_trend_delta(spark, sf):
    return reports.trend_by_time(table(spark, sf, "orders"), "o_orderdate", "year", "n", delta="delta")


@query("trend_decade_orders", """
SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS period, count(*) AS n FROM orders GROUP BY 1""")
def q_trend_decade(spark, sf):
    return reports.trend_by_time(table(spark, sf, "orders"), "o_orderdate", "decade", "n")


@query("segment_report_customer", f"""
SELECT c_mktsegment, count(*) AS n, {R('avg(c_acctbal)', 2)} AS avg_balance FROM customer
GROUP BY c_mktsegment HAVING count(*) >= 5 ORDER BY n DESC, c_mktsegment ASC NULLS FIRST LIMIT 3""")
def q_segment_report(spark, sf):
    return reports.group_report(table(spark, sf, "customer"), "c_mktsegment", "n",
                                {"avg_balance": ("c_acctbal", 2)}, min_count=5, order=[F.col("n").desc()], k=3)


def _registry() -> dict[str, tuple[Builder, str | None]]:
    from . import more_queries  # noqa: F401  (registers the second part)
    return REGISTRY


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in _registry().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _registry().items() if sql is not None}
