"""Reports of analysts and operators over audit rows, history and job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import OK, PARTIAL


def latest_run(recon: DataFrame, by_text: bool = False) -> DataFrame:
    """Rows of the run committed last; ``by_text``: of the run whose id sorts last."""
    last = recon.agg((F.max("run_id") if by_text else F.max(F.struct("committed_at", "run_id"))["run_id"]).alias("run_id"))
    return recon.where(F.col("run_id") == last.scalar())


def recon_failures(recon: DataFrame, by_text: bool = False) -> DataFrame:
    return latest_run(recon, by_text).where(~F.col("status").isin(OK, PARTIAL))


def recon_drop_rate(recon: DataFrame) -> DataFrame:
    """Of each day and table: records dropped, as the details tell, and landed."""
    dropped = F.get_json_object("details", "$.numRecordsDropped").cast("bigint")
    return recon.where("tier = 'A'").groupBy(F.date_trunc("day", "committed_at").alias("day"), "table_name").agg(F.sum(dropped).alias("dropped"), F.sum("actual").alias("landed"))


def table_coverage(recon: DataFrame) -> DataFrame:
    return recon.groupBy("table_name").agg(F.max("committed_at").alias("last_committed"))


def stale_tables(recon: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    return table_coverage(recon).where(F.col("last_committed") < F.date_trunc("day", as_of) - F.make_dt_interval(F.lit(days)))


def tables_loaded(recon: DataFrame) -> DataFrame:
    return recon.agg(F.count_distinct("table_name").alias("tables"))


def tables_loaded_since(recon: DataFrame, since: Column) -> DataFrame:
    return recon.where(F.col("committed_at") >= since).agg(F.count_distinct("table_name").alias("tables"), F.count(F.lit(1)).alias("checks"))


def run_status_summary(recon: DataFrame) -> DataFrame:
    return latest_run(recon).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def bad_rows(recon: DataFrame) -> DataFrame:
    return recon.where(~F.col("status").isin(OK, PARTIAL)).agg(F.count(F.lit(1)).alias("n"))


def check_status_matrix(recon: DataFrame) -> DataFrame:
    return recon.groupBy("check_name", "status").agg(F.count(F.lit(1)).alias("n"))


def tier_d_violations(recon: DataFrame, most: int = 100) -> DataFrame:
    """The latest violations of tier D; the limit is the report's."""
    found = recon.where((F.col("tier") == "D") & (F.col("status") != OK))
    return found.orderBy(F.desc("committed_at"), "table_name", "check_name").limit(most)


def rows_per_load_day(history: DataFrame) -> DataFrame:
    return history.groupBy(F.date_trunc("day", "load_ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def job_durations(runs: DataFrame) -> DataFrame:
    return runs.withColumn("seconds", F.coalesce("duration", F.col("updated") - F.col("created")))


def slowest_jobs(runs: DataFrame, most: int = 10) -> DataFrame:
    out = job_durations(runs).where("state = 'SUCCESS'").orderBy(F.desc("seconds"), "name", "event_id").limit(most)
    return out.select("name", "event_id", "seconds")


def job_timing(runs: DataFrame, percents: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """One row: runs by state; least, nearest-rank percentiles, most and total seconds of successes.

    A percentile is the value at place min(n - 1, int(p / 100 * n)) in order. Values are
    counted first, in ranges of a second, so that ranks come from sums of counts. The sums of
    ranges are ordered in one task: there are as many as seconds that the longest run took.
    """
    timed = job_durations(runs)
    states = timed.agg(*[F.count_if(F.col("state") == s).alias(s.lower()) for s in ("SUCCESS", "FAILED", "CANCELLED")])
    done = timed.where("state = 'SUCCESS' and seconds is not null").groupBy("seconds").agg(F.count(F.lit(1)).alias("n"))
    done = done.withColumn("range", F.floor("seconds"))
    per_range = done.groupBy("range").agg(F.sum("n").alias("in_range"))
    before = per_range.withColumn("before", F.sum("in_range").over(Window.orderBy("range")) - F.col("in_range")).drop("in_range")
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("seconds"))
    ranked = done.withColumn("upto", upto).join(before, "range").withColumn("upto", F.col("upto") + F.col("before"))
    total = done.agg(F.sum("n").alias("total"), F.min("seconds").alias("min_s"), F.max("seconds").alias("max_s"), F.sum(F.round(F.col("seconds") * 1000).cast("long") * F.col("n")).alias("total_ms"))
    n = total.select("total").scalar()
    place = lambda p: F.least(n - 1, F.floor(F.lit(p / 100) * n).cast("long"))
    names = [f"p{p}_s" for p in percents]
    at = [F.min(F.when(F.col("upto") > place(p), F.col("seconds"))).alias(c) for p, c in zip(percents, names, strict=True)]
    quantiles = ranked.agg(*at).select(F.struct(*names)).scalar()
    totals = total.drop("total").select(F.struct("*")).scalar()
    return states.select("*", totals.alias("t"), quantiles.alias("q")).select(*states.columns, "t.*", "q.*")
