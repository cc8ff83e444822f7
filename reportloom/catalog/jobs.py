"""End-to-end jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.numbers import decimals_to_double
from ..operators.aggregates import bracket_tail, monthly_summary, per_capita, pooled_rate
from ..operators.filters import keep_in, slice_rows
from ..operators.ranking import sample_head
from ..plans import cohort as cohorts
from ..plans import regional
from ..plans.bulletin import NARRATIVE, bulletin_facts, category_matrix, category_trend
from ..plans.doc_retrieval import answer, cited_answers, rebuild_cited_index, rebuild_index
from ..plans.feed_digest import digest_page
from ..plans.refinery import refine, with_label
from ..sources.delimited import latest_label, read_parts
from ..sources.feeds import read_feed
from ..sources.outputs import export_parts, write_labelled
from ..sources.tables import complaints, population, table
from ..workspace import fresh_dir
from .aggregates import IN_REGIONS, LABELS_SQL, PROFILE, REGIONS
from .filters import COHORT, NEWEST_QUARTER, REGION, newest_quarter
from .registry import MONTHLY, POPULATION, over, query
from .sources import CHUNKS_SQL, ITEMS_SQL, append_raw_file, dated_items, write_dated_feeds, write_raw
from .text import SLOTS_SQL, VECTOR_SQL, documents

COHORT_SQL = """cohort_v AS (SELECT * FROM complaints_v WHERE age_range = '''10 - 19')"""
LOCAL = "province = 'NATION_3'"


def share(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100"


def rate(count: str, people: str) -> str:
    return f"CAST({count} AS DOUBLE) / ({people} * 1000) * 100000"


# ---------------------------------------------------------------- refinery, bulletin, export


@query(
    "e01_refinery",
    over(
        """SELECT (SELECT year(max(date)) || '_Q' || quarter(max(date)) FROM complaints_v WHERE country <> 'ASIA') AS label,
                  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                  CAST(sum(dollar_loss) AS DOUBLE) AS total_loss, CAST(sum(num_victims) AS BIGINT) AS total_victims
           FROM complaints_v WHERE country <> 'ASIA' GROUP BY ALL"""
    ),
)
def e01(spark, sf_dir):
    base = fresh_dir(spark, "refinery")
    write_raw(complaints(spark, sf_dir), f"{base}/drops/drop_1")
    done = refine(spark, f"{base}/drops", f"{base}/out", glob="*.csv", country_sentinel="ASIA", delivery=True)
    monthly = decimals_to_double(done.monthly).withColumn("label", F.lit(done.label))
    return monthly.select("label", "year", "month", "total_loss", "total_victims")


@query(
    "e01_refinery_newest_file",
    over(
        """SELECT (SELECT year(max(date)) || '_Q' || quarter(max(date)) FROM complaints_v WHERE country <> 'ASIA') AS label,
                  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                  CAST(sum(dollar_loss) AS DOUBLE) AS total_loss, CAST(sum(num_victims) AS BIGINT) AS total_victims
           FROM complaints_v WHERE country <> 'ASIA' GROUP BY ALL"""
    ),
)
def e01_newest_file(spark, sf_dir):
    """An older file of the same folder states some reports too; only the newer file counts."""
    base, reports = fresh_dir(spark, "refinery"), complaints(spark, sf_dir)
    append_raw_file(reports.filter("date < date '1998-01-01'"), f"{base}/drops")
    append_raw_file(reports, f"{base}/drops")
    done = refine(spark, f"{base}/drops", f"{base}/out", glob="*.csv", country_sentinel="ASIA")
    monthly = decimals_to_double(done.monthly).withColumn("label", F.lit(done.label))
    return monthly.select("label", "year", "month", "total_loss", "total_victims")


def narrative_sql() -> str:
    """The bulletin's sentence with its blanks filled by SQL."""
    blanks = (
        "label", "'reporting centre'", "loss_month", "peak_loss", "victims_month", "peak_victims",
        "CASE WHEN loss_month = victims_month THEN 'a parallel spike' ELSE 'a strong divergence' END",
    )
    pieces = [f"'{piece}'" for piece in NARRATIVE.split("%s")]
    return pieces[0] + "".join(f" || {blank} || {piece}" for blank, piece in zip(blanks, pieces[1:]))


@query(
    "e02_bulletin_facts",
    over(
        """SELECT label, min_date, max_date, peak_loss, loss_month, peak_victims, victims_month,
                  CASE WHEN loss_month = victims_month THEN 'parallel spike' ELSE 'strong divergence' END AS divergence,
                  """
        + narrative_sql()
        + """ AS narrative
           FROM (SELECT year(hi) || '_Q' || quarter(hi) AS label, lo AS min_date, hi AS max_date,
                        '$' || format('{:,}', CAST(round_even(CAST(l.total_loss AS DOUBLE), 0) AS BIGINT)) AS peak_loss,
                        strftime(l.month_date, '%B %Y') AS loss_month, format('{:,}', v.total_victims) AS peak_victims,
                        strftime(v.month_date, '%B %Y') AS victims_month
                 FROM (SELECT min(date) AS lo, max(date) AS hi FROM complaints_v),
                      (SELECT * FROM monthly_v ORDER BY total_loss DESC NULLS LAST, month_date LIMIT 1) l,
                      (SELECT * FROM monthly_v ORDER BY total_victims DESC NULLS LAST, month_date LIMIT 1) v)""",
        MONTHLY,
    ),
)
def e02(spark, sf_dir):
    return bulletin_facts(complaints(spark, sf_dir, "date", "dollar_loss", "num_victims"))


TOP_THREE = """top_v AS (SELECT fraud_cat FROM quarter_v GROUP BY 1 ORDER BY sum(dollar_loss) DESC NULLS LAST, fraud_cat LIMIT 3)"""


@query(
    "e02_category_trend",
    over(
        """SELECT CAST(date_trunc('month', date) AS DATE) AS month_date, fraud_cat, CAST(sum(dollar_loss) AS DOUBLE) AS total_loss
           FROM quarter_v WHERE fraud_cat IN (SELECT fraud_cat FROM top_v) GROUP BY ALL""",
        NEWEST_QUARTER,
        TOP_THREE,
    ),
)
def e02_trend(spark, sf_dir):
    trend = category_trend(newest_quarter(spark, sf_dir, "date", "fraud_cat", "dollar_loss"))
    return decimals_to_double(trend).select("month_date", "fraud_cat", "total_loss")


@query(
    "e03_category_matrix",
    over(
        """SELECT month_date, rank, CAST(coalesce(total, 0) AS DOUBLE) AS total_loss
           FROM (SELECT fraud_cat, CAST(row_number() OVER (ORDER BY sum(total) DESC NULLS LAST, fraud_cat) AS INTEGER) AS rank
                 FROM cells_v GROUP BY 1) CROSS JOIN (SELECT DISTINCT month_date FROM cells_v)
                LEFT JOIN cells_v USING (fraud_cat, month_date)""",
        NEWEST_QUARTER,
        TOP_THREE,
        """cells_v AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month_date, fraud_cat, sum(dollar_loss) AS total
             FROM quarter_v WHERE fraud_cat IN (SELECT fraud_cat FROM top_v) GROUP BY ALL)""",
    ),
)
def e03(spark, sf_dir):
    matrix = category_matrix(newest_quarter(spark, sf_dir, "date", "fraud_cat", "dollar_loss"))
    names = matrix.columns[1:]
    ranked = matrix.toDF("month_date", *[str(i) for i in range(1, len(names) + 1)])
    long = ranked.unpivot(["month_date"], [str(i) for i in range(1, len(names) + 1)], "rank", "total_loss")
    return decimals_to_double(long.withColumn("rank", F.col("rank").cast("int")))


@query(
    "e04_merge_export",
    over(
        """SELECT year, month, CAST(sum(dollar_loss) AS DOUBLE) AS total_loss, CAST(sum(num_victims) AS BIGINT) AS total_victims
           FROM (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, dollar_loss, num_victims
                 FROM quarter_v) GROUP BY ALL ORDER BY year, month LIMIT 6""",
        NEWEST_QUARTER,
    ),
)
def e04(spark, sf_dir):
    base = fresh_dir(spark, "merge")
    reports = complaints(spark, sf_dir, "id", "date", "dollar_loss", "num_victims")
    labelled = with_label(reports)
    filed = spark.read.schema(labelled.schema).parquet(write_labelled(labelled, f"{base}/labelled"))
    merged = monthly_summary(latest_label(filed))
    export_parts(merged, f"{base}/download", "year", "month")
    download = read_parts(spark, f"{base}/download", schema="year int, month int, total_loss double, total_victims bigint")
    return sample_head(download, "year", "month")


# ---------------------------------------------------------------- regional


@query(
    "e05_heat_table",
    over(
        f"""SELECT province, fraud_cat, coalesce(n, 0) AS n, coalesce(pct, 0) AS pct
            FROM (SELECT province FROM cells_v GROUP BY 1 ORDER BY sum(n) DESC, province LIMIT 8)
                 CROSS JOIN (SELECT fraud_cat FROM cells_v GROUP BY 1 ORDER BY sum(n) DESC, fraud_cat LIMIT 10)
                 LEFT JOIN (SELECT *, {share("n", "sum(n) OVER (PARTITION BY province)")} AS pct FROM cells_v) USING (province, fraud_cat)""",
        """cells_v AS (SELECT province, fraud_cat, count(*) AS n FROM complaints_v
             WHERE province IS NOT NULL AND fraud_cat IS NOT NULL GROUP BY 1, 2)""",
    ),
)
def e05(spark, sf_dir):
    return regional.heat_table(complaints(spark, sf_dir, "province", "fraud_cat"))


ONE_REGION = "(SELECT sum(population) FROM population_v WHERE province = 'NATION_3')"


def split_counts(key: str) -> str:
    return f"""split_v AS (SELECT * FROM (SELECT {key}, count(*) FILTER ({LOCAL}) AS slice_n, count(*) AS all_n
                 FROM complaints_v WHERE {key} IS NOT NULL GROUP BY 1) WHERE slice_n > 0)"""


@query(
    "e06_region_categories",
    over(
        f"""SELECT *, CASE WHEN rate_ratio > 1 THEN 'Above National' ELSE 'Below National' END AS level
            FROM (SELECT *, slice_rate / all_rate AS rate_ratio FROM (SELECT *, {rate("slice_n", ONE_REGION)} AS slice_rate,
                  {rate("all_n", "(SELECT sum(population) FROM population_v)")} AS all_rate FROM split_v))
            ORDER BY slice_rate DESC, fraud_cat LIMIT 10""",
        POPULATION,
        split_counts("fraud_cat"),
    ),
)
def e06_categories(spark, sf_dir):
    return regional.region_categories(complaints(spark, sf_dir, "province", "fraud_cat"), population(spark, sf_dir), REGION)


@query(
    "e06_region_contribution",
    over(
        f"SELECT *, {share('slice_n', 'all_n')} AS share_pct FROM split_v ORDER BY slice_n DESC, fraud_cat LIMIT 8",
        split_counts("fraud_cat"),
    ),
)
def e06_contribution(spark, sf_dir):
    return regional.region_contribution(complaints(spark, sf_dir, "province", "fraud_cat"), REGION)


@query(
    "e06_region_ages",
    over(
        f"""SELECT *, {share("slice_n", "all_n")} AS share_pct, {rate("slice_n", ONE_REGION)} AS slice_rate FROM split_v
            WHERE slice_n > 20 AND age_range NOT LIKE '%Not Available%' AND age_range NOT LIKE '%non disponible%'""",
        POPULATION,
        split_counts("age_range"),
    ),
)
def e06_ages(spark, sf_dir):
    return regional.region_ages(complaints(spark, sf_dir, "province", "age_range"), population(spark, sf_dir), REGION, 20)


@query(
    "e06_region_genders",
    over(f"SELECT gender, count(*) AS n FROM complaints_v WHERE {LOCAL} AND gender IS NOT NULL GROUP BY 1 HAVING count(*) > 50"),
)
def e06_genders(spark, sf_dir):
    return regional.region_genders(complaints(spark, sf_dir, "province", "gender"), REGION, 50)


AGES = ["'20 - 29", "'30 - 39", "'40 - 49", "'50 - 59", "'60 - 69", "'70 - 79"]
CATEGORIES = ["1-URGENT", "2-HIGH", "5-LOW"]


@query(
    "e06_region_age_categories",
    over(
        f"""SELECT * FROM (SELECT *, {share("n", "sum(n) OVER (PARTITION BY age_range)")} AS pct
              FROM (SELECT age_range, fraud_cat, count(*) AS n FROM complaints_v WHERE {LOCAL} AND age_range IS NOT NULL
                    AND fraud_cat IS NOT NULL GROUP BY 1, 2))
            WHERE age_range IN ('''20 - 29', '''30 - 39', '''40 - 49', '''50 - 59', '''60 - 69', '''70 - 79')
                  AND fraud_cat IN ('1-URGENT', '2-HIGH', '5-LOW')"""
    ),
)
def e06_age_categories(spark, sf_dir):
    rows = complaints(spark, sf_dir, "province", "age_range", "fraud_cat")
    return regional.region_age_categories(rows, REGION, AGES, CATEGORIES)


# ---------------------------------------------------------------- cohort


def years(first: int, last: int | None = None):
    return dt.date(first, 1, 1), dt.date((last or first) + 1, 1, 1)


def cohort(spark, sf_dir, *wanted, period=None):
    """Only the wanted columns' dimensions are joined."""
    return slice_rows(complaints(spark, sf_dir, "age_range", *wanted, period=period), age_range=COHORT)


def local_cohort(spark, sf_dir, *wanted, period=None):
    return slice_rows(cohort(spark, sf_dir, "province", *wanted, period=period), province=REGION)


def breakdown_sql(key: str) -> str:
    return f"""SELECT * FROM (SELECT {key}, n, {share("n", "sum(n) OVER ()")} AS pct FROM (SELECT {key}, count(*) AS n
               FROM cohort_v WHERE {LOCAL} AND {key} IS NOT NULL GROUP BY 1)) WHERE n > 5"""


@query("e07_cohort_methods", over(breakdown_sql("sol_method"), COHORT_SQL))
def e07_methods(spark, sf_dir):
    return cohorts.cohort_breakdown(local_cohort(spark, sf_dir, "sol_method"), "sol_method", 5)


@query("e07_cohort_categories", over(breakdown_sql("fraud_cat"), COHORT_SQL))
def e07_categories(spark, sf_dir):
    return cohorts.cohort_breakdown(local_cohort(spark, sf_dir, "fraud_cat"), "fraud_cat", 5)


@query(
    "e07_cohort_share",
    over(
        f"""SELECT sol_method, slice_n, all_n, {share("slice_n", "all_n")} AS share_pct FROM (SELECT sol_method,
            count(*) FILTER ({LOCAL}) AS slice_n, count(*) AS all_n FROM cohort_v WHERE sol_method IS NOT NULL GROUP BY 1)
            WHERE slice_n > 5""",
        COHORT_SQL,
    ),
)
def e07_share(spark, sf_dir):
    return cohorts.cohort_share(cohort(spark, sf_dir, "province", "sol_method"), REGION, "sol_method", 5)


@query(
    "e07_cohort_losses",
    over(
        f"""SELECT age_range, {PROFILE}, CASE WHEN age_range = '''10 - 19' THEN 'Cohort' ELSE 'Other Ages' END AS age_group
            FROM complaints_v WHERE {LOCAL} AND dollar_loss > 0 AND age_range NOT LIKE '%Not Available%' GROUP BY 1 HAVING count(*) > 20"""
    ),
)
def e07_losses(spark, sf_dir):
    rows = complaints(spark, sf_dir, "province", "age_range", "dollar_loss")
    return decimals_to_double(cohorts.cohort_losses(rows, REGION, COHORT, 20))


@query(
    "e07_cohort_loss_comparison",
    over(
        f"""SELECT 'slice' AS scope, {PROFILE} FROM cohort_v WHERE {LOCAL} AND dollar_loss > 0
            UNION ALL SELECT 'all', {PROFILE} FROM cohort_v WHERE dollar_loss > 0""",
        COHORT_SQL,
    ),
)
def e07_comparison(spark, sf_dir):
    return decimals_to_double(cohorts.cohort_loss_comparison(cohort(spark, sf_dir, "province", "dollar_loss"), REGION))


LOCAL_LABELS = LABELS_SQL.replace("LEFT JOIN complaints_v", f"LEFT JOIN (SELECT * FROM cohort_v WHERE {LOCAL})")


@query(
    "e07_cohort_brackets",
    over(f"SELECT bracket_no, bracket, n, {share('n', '(SELECT sum(n) FROM dist_v)')} AS pct FROM dist_v", COHORT_SQL, LOCAL_LABELS),
)
def e07_brackets(spark, sf_dir):
    return cohorts.cohort_brackets(cohort(spark, sf_dir, "province", "dollar_loss"), REGION)


@query(
    "e07_cohort_tails",
    over(
        f"""SELECT CAST(sum(n) FILTER (bracket_no >= 5) AS BIGINT) AS over_5000_n,
                   CAST(sum(n) FILTER (bracket_no <= 2) AS BIGINT) AS under_500_n,
                   {share("sum(n) FILTER (bracket_no >= 5)", "sum(n)")} AS over_5000_pct,
                   {share("sum(n) FILTER (bracket_no <= 2)", "sum(n)")} AS under_500_pct FROM dist_v""",
        COHORT_SQL,
        LOCAL_LABELS,
    ),
)
def e07_tails(spark, sf_dir):
    dist = cohorts.cohort_brackets(cohort(spark, sf_dir, "province", "dollar_loss"), REGION)
    return bracket_tail(dist, {"over_5000": ["$5001-10000", ">$10000"], "under_500": ["$1-100", "$101-500"]})


@query(
    "e08_cohort_years",
    over(
        """SELECT year, n, n - before AS yoy_change,
                  (CAST(n AS DOUBLE) - CAST(before AS DOUBLE)) / nullif(CAST(before AS DOUBLE), 0) * 100 AS yoy_pct_change
           FROM (SELECT year, n, lag(n) OVER (ORDER BY year) AS before FROM (SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n
                 FROM cohort_v WHERE province = 'NATION_3' AND date IS NOT NULL GROUP BY 1))""",
        COHORT_SQL,
    ),
)
def e08_years(spark, sf_dir):
    return cohorts.cohort_years(local_cohort(spark, sf_dir, "date"))


@query(
    "e08_cohort_seasons",
    over(
        """SELECT month, CAST(sum(n) AS DOUBLE) / count(*) AS avg_monthly, CAST(sum(n) AS BIGINT) AS total_monthly,
                  strftime(make_date(2000, month, 1), '%B') AS month_name
           FROM (SELECT CAST(month(date) AS INTEGER) AS month, year(date) AS y, count(*) AS n FROM cohort_v GROUP BY ALL)
           GROUP BY 1 HAVING sum(n) > 20""",
        COHORT_SQL,
    ),
)
def e08_seasons(spark, sf_dir):
    return cohorts.cohort_seasons(cohort(spark, sf_dir, "date"), 20)


@query(
    "e08_cohort_share_by_year",
    over(
        f"""SELECT year, slice_n, all_n, {share("slice_n", "all_n")} AS share_pct FROM (SELECT CAST(year(date) AS INTEGER) AS year,
            count(*) FILTER ({LOCAL}) AS slice_n, count(*) AS all_n FROM cohort_v WHERE date IS NOT NULL GROUP BY 1) WHERE slice_n > 0""",
        COHORT_SQL,
    ),
)
def e08_share(spark, sf_dir):
    return cohorts.cohort_share_by_year(cohort(spark, sf_dir, "province", "date"), REGION)


@query(
    "e08_year_rates",
    over(
        f"""SELECT *, {rate("n", "population")} AS rate_per_100k FROM (SELECT province, count(*) AS n FROM cohort_v
            WHERE year(date) = 1997 AND {IN_REGIONS} GROUP BY 1) JOIN population_v USING (province)""",
        POPULATION,
        COHORT_SQL,
    ),
)
def e08_year_rates(spark, sf_dir):
    rows = keep_in(cohort(spark, sf_dir, "province", period=years(1997)), "province", REGIONS)
    return per_capita(rows, population(spark, sf_dir), "province")


@query(
    "e08_pooled_rate",
    over(
        f"""SELECT CAST(sum(n) AS BIGINT) AS n, sum(population) AS population, {rate("sum(n)", "sum(population)")} AS rate_per_100k
            FROM (SELECT province, count(*) AS n FROM cohort_v WHERE year(date) = 1997 AND {IN_REGIONS} GROUP BY 1)
                 JOIN population_v USING (province)""",
        POPULATION,
        COHORT_SQL,
    ),
)
def e08_pooled(spark, sf_dir):
    rows = cohort(spark, sf_dir, "province", period=years(1997))
    return pooled_rate(rows, population(spark, sf_dir), "province", REGIONS)


YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@query(
    "e08_cohort_rates_wide",
    over(
        "SELECT province, "
        + ", ".join(f"sum(r) FILTER (y = {y}) AS rate_{y}" for y in YEARS)
        + f""" FROM (SELECT province, y, {rate("n", "population")} AS r FROM (SELECT province, year(date) AS y, count(*) AS n
               FROM cohort_v WHERE {IN_REGIONS} GROUP BY ALL) JOIN population_v USING (province)) GROUP BY 1""",
        POPULATION,
        COHORT_SQL,
    ),
)
def e08_rates(spark, sf_dir):
    return cohorts.cohort_rates_wide(cohort(spark, sf_dir, "province", "date"), population(spark, sf_dir), REGIONS, YEARS)


def decline_sql(key: str) -> str:
    cases = " ".join(f"WHEN change_pct < {below} THEN '{label}'" for below, label in cohorts.DECLINES)
    return f"""SELECT *, CASE {cases} ELSE '{cohorts.OTHER_DECLINE}' END AS severity
               FROM (SELECT {key}, n_before, n_after, (CAST(n_after AS DOUBLE) - CAST(n_before AS DOUBLE)) / CAST(n_before AS DOUBLE) * 100 AS change_pct
                     FROM (SELECT {key}, count(*) FILTER (year(date) = 1996) AS n_before, count(*) FILTER (year(date) = 1997) AS n_after
                           FROM cohort_v WHERE {LOCAL} AND {key} IS NOT NULL GROUP BY 1) WHERE n_before > 0)"""


@query("e08_category_decline", over(decline_sql("fraud_cat"), COHORT_SQL))
def e08_category_decline(spark, sf_dir):
    rows = local_cohort(spark, sf_dir, "date", "fraud_cat", period=years(1996, 1997))
    return cohorts.cohort_decline(rows, "fraud_cat", 1996, 1997)


@query("e08_method_decline", over(decline_sql("sol_method"), COHORT_SQL))
def e08_method_decline(spark, sf_dir):
    rows = local_cohort(spark, sf_dir, "date", "sol_method", period=years(1996, 1997))
    return cohorts.cohort_decline(rows, "sol_method", 1996, 1997)


# ---------------------------------------------------------------- feeds and documents


@query(
    "e09_feed_digest",
    f"""WITH {ITEMS_SQL},
             dated AS (SELECT *, max(item_day) OVER (PARTITION BY page_id // 50) AS feed_day FROM items_v),
             t AS (SELECT feed_day, item_day, item_link, item_description,
                          replace(replace(replace(item_title, '&', '&amp;'), '<', '&lt;'), '''', '&#39;') AS title,
                          replace(replace(replace(item_link, '&', '&amp;'), '<', '&lt;'), '''', '&#39;') AS link
                   FROM dated WHERE regexp_matches(item_title, 'the|tion', 'i') OR regexp_matches(item_description, 'the|tion', 'i'))
        SELECT '<a target=''_blank'' title=''' || title || ''' href=''' || link || ''' rel=''noopener''>' || title || '</a>' AS item,
               feed_day, item_day, item_description FROM t ORDER BY feed_day DESC, item_day DESC, item_link LIMIT 10 OFFSET 10""",
)
def e09(spark, sf_dir):
    path = write_dated_feeds(dated_items(spark, sf_dir), fresh_dir(spark, "feeds"))
    items = read_feed(spark, path).withColumn("item_title", F.trim("item_title"))
    page = digest_page(items, "the|tion", 2)
    days = [F.to_date("feed_pub_date").alias("feed_day"), F.to_date("item_pub_date").alias("item_day")]
    return page.select("item", *days, "item_description")


@query(
    "e10_doc_retrieval",
    f"""WITH {CHUNKS_SQL},
             index_v AS (SELECT doc_id, chunk_no, {VECTOR_SQL} AS v FROM (SELECT doc_id, chunk_no,
                         {SLOTS_SQL.format(words="list_transform(cw, lambda y: lower(y))")} AS slots FROM chunks_v)),
             asked AS (SELECT query_id, {VECTOR_SQL} AS q FROM (SELECT item_id AS query_id,
                       {SLOTS_SQL.format(words="string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')")} AS slots FROM benchmark)),
             scored AS (SELECT query_id, doc_id, chunk_no, round(list_dot_product(q, v)
                        / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))), 9) AS score FROM asked, index_v)
        SELECT query_id, doc_id, chunk_no, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (
               PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_no) AS rank FROM scored) WHERE rank <= 5""",
)
def e10(spark, sf_dir):
    index = rebuild_index(documents(spark, sf_dir), "doc_id", "text", fresh_dir(spark, "index"))
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return answer(index, questions, "doc_id").select("query_id", "doc_id", "chunk_no", "rank")


WORDS_SQL = "string_split(trim(regexp_replace(lower({text}), '\\s+', ' ', 'g')), ' ')"


@query(
    "e10_cited_retrieval",
    f"""WITH lines_v AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS section
                         FROM documents WHERE regexp_replace(text, '\\s+', '', 'g') <> ''),
             words_v AS (SELECT doc_id, list_filter(list_transform(string_split(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' '),
                                lambda x: {{'w': x, 's': section}}), lambda x: x.w <> '') AS w, section FROM lines_v),
             texts_v AS (SELECT doc_id, flatten(list(w ORDER BY section)) AS w FROM words_v GROUP BY 1),
             chunks_v AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, w[i * 180 + 1 : i * 180 + 200] AS cw FROM (
                          SELECT doc_id, w, unnest(range(CAST(greatest(ceil((len(w) - 20) / 180.0), 1) AS BIGINT))) AS i FROM texts_v)),
             terms_v AS (SELECT doc_id, chunk_no, lower(unnest(cw).w) AS term FROM chunks_v),
             known_v AS (SELECT term, ln((1 + (SELECT count(*) FROM chunks_v)) / (1.0::DOUBLE + count(DISTINCT (doc_id, chunk_no)))) + 1 AS weight
                         FROM terms_v GROUP BY 1),
             asked_v AS (SELECT item_id AS query_id, unnest({WORDS_SQL.format(text="text")}) AS term FROM benchmark),
             q_v AS (SELECT query_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS slot,
                            sum(coalesce(weight, ln(1.0::DOUBLE + (SELECT count(*) FROM chunks_v)) + 1)) AS q
                     FROM asked_v LEFT JOIN known_v USING (term) GROUP BY ALL),
             v_v AS (SELECT doc_id, chunk_no, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS slot, sum(weight) AS v
                     FROM terms_v JOIN known_v USING (term) GROUP BY ALL),
             scored AS (SELECT query_id, doc_id, chunk_no, round(coalesce(sum(q * v), 0) / (any_value(ql) * any_value(vl)), 9) AS score
                        FROM (SELECT DISTINCT doc_id, chunk_no FROM chunks_v) CROSS JOIN (SELECT DISTINCT query_id FROM q_v)
                        JOIN (SELECT query_id, sqrt(sum(q * q)) AS ql FROM q_v GROUP BY 1) USING (query_id)
                        JOIN (SELECT doc_id, chunk_no, sqrt(sum(v * v)) AS vl FROM v_v GROUP BY ALL) USING (doc_id, chunk_no)
                        JOIN v_v USING (doc_id, chunk_no) LEFT JOIN q_v USING (query_id, slot) GROUP BY ALL),
             best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_no) AS rank FROM scored)
        SELECT query_id, doc_id, chunk_no, CAST(cw[1].s AS INTEGER) AS first_section, CAST(cw[-1].s AS INTEGER) AS last_section,
               CAST(rank AS INTEGER) AS rank FROM best JOIN chunks_v USING (doc_id, chunk_no) WHERE rank <= 5""",
)
def e10_cited(spark, sf_dir):
    """Rare words weigh more, and each hit names the sections (lines) that its chunk covers."""
    path = fresh_dir(spark, "cited-index")
    rebuild_cited_index(documents(spark, sf_dir), "doc_id", "text", path, cells=32)
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return cited_answers(path, questions, "doc_id").select("query_id", "doc_id", "chunk_no", "first_section", "last_section", "rank")
