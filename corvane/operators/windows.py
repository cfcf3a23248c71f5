"""Search windows: what a query has covered by year and by index date, and what to fetch next. The ledger is a small table of windows.

space: terms, combine, sources, date_field. A ledger has query (hash), kind (year or index), date_from, date_to, fetched, fetched_at. Late
records are found by index windows, which go by the day a record was indexed and not by its own date, so nothing is ever too late.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_FIELD, FAR = "FIRST_IDATE", "3000-12-31"
LEDGER = "query string, kind string, date_from date, date_to date, fetched long, fetched_at date"


class Refused(ValueError):
    """A window that would leave a gap."""


def clause(space: dict, dates: str) -> str:
    out = f"({f' {space.get('combine', 'OR')} '.join(space['terms'])}) AND ({dates})"
    return out + (" AND (" + " OR ".join(f"SRC:{s}" for s in space["sources"]) + ")" if space.get("sources") else "")


def year_query(space: dict, date_from: str, date_to: str) -> str:
    return clause(space, f"{space.get('date_field', 'FIRST_PDATE')}:[{date_from} TO {date_to}]")


def index_query(space: dict, since: str, up_to: str, future_from: str | None = None) -> str:
    """All indexed from since to up_to; with future_from also what is dated from that day on."""
    return clause(space, f"{INDEX_FIELD}:[{since} TO {up_to}]" + (f" OR {space.get('date_field', 'FIRST_PDATE')}:[{future_from} TO {FAR}]" if future_from else ""))


def space_hash(space: dict) -> str:
    """The same for any order of terms and sources; another for any other search."""
    text = json.dumps({"combine": space.get("combine", "OR"), "date_field": space.get("date_field", "FIRST_PDATE"), "sources": sorted(space.get("sources", [])), "terms": sorted(space["terms"])}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def window_for(year: Column, up_to: str) -> Column:
    """A year's first and last day, the last not after up_to."""
    return F.struct(F.make_date(year, F.lit(1), F.lit(1)).alias("date_from"), F.least(F.make_date(year, F.lit(12), F.lit(31)), F.lit(up_to).cast("date")).alias("date_to"))


def covered_years(ledger: DataFrame, whole: bool = False) -> DataFrame:
    """Years that a year window touches; whole: covers from the first to the last day."""
    a, b = F.year("date_from"), F.year("date_to")
    if whole:
        a = a + F.when(F.date_format("date_from", "MM-dd") == "01-01", 0).otherwise(1)
        b = b - F.when(F.date_format("date_to", "MM-dd") == "12-31", 0).otherwise(1)
    w = ledger.where("kind = 'year'").select(a.alias("a"), b.alias("b")).where("a <= b")
    return w.select(F.explode(F.sequence("a", "b")).alias("year")).distinct()


def missing_years(ledger: DataFrame, first: int, up_to: str) -> DataFrame:
    """Years from first that aren't covered whole; the current one is never done."""
    now = int(up_to[:4])
    axis = ledger.sparkSession.range(first, now + 1, 1, 1).select(F.col("id").cast("int").alias("year"))
    return axis.join(covered_years(ledger, True).where(F.col("year") != now), "year", "left_anti")


def indexed_through(ledger: DataFrame) -> DataFrame:
    """One row: the last day up to which all that was indexed has been fetched (null before any fetch), and the first day that no window's dates reach (null once there is an index window)."""
    day = F.when(F.col("kind") == "index", F.least("date_to", "fetched_at")).otherwise(F.col("fetched_at"))
    last = F.max(F.when(F.col("kind") == "year", F.struct("fetched_at", "date_to")))
    return ledger.where("fetched_at is not null").agg(F.max(day).alias("through"), F.when(F.count_if(F.col("kind") == "index") == 0, F.date_add(last["date_to"], 1)).alias("future_from"))


def plan_index(ledger: DataFrame, first: int, up_to: str, since: str = "last") -> tuple[str, str | None]:
    """The days since and, for the first index window, from which future-dated records are fetched too. Refused where a gap would stay or nothing is left."""
    row = indexed_through(ledger).first()
    if row.through is None:
        raise Refused("nothing has been fetched yet: run the year windows first")
    axis = ledger.sparkSession.range(first, int(up_to[:4]), 1, 1).select(F.col("id").cast("int").alias("year"))
    never = [r.year for r in axis.join(covered_years(ledger), "year", "left_anti").orderBy("year").limit(10).collect()]
    if never:
        raise Refused(f"years never fetched: {never}")
    through = row.through.isoformat()
    start = through if since == "last" else since
    if start > through:
        raise Refused(f"{start} starts after {through}: records in between would be missed")
    if start > up_to:
        raise Refused(f"all is covered up to {start}")
    return start, row.future_from.isoformat() if row.future_from else None


def recorded(ledger: DataFrame, windows: DataFrame) -> DataFrame:
    """ledger with windows added; one of the same query, kind and dates takes the old one's place."""
    key = ["query", "kind", "date_from", "date_to"]
    return ledger.join(windows.select(*key), key, "left_anti").select(*ledger.columns).unionByName(windows.select(*ledger.columns))


def random_weeks(spark: SparkSession, first: int, last: int, n: int, seed: int) -> DataFrame:
    """n windows of seven days, drawn by MD5 from all days of the years but the last six."""
    days = f"datediff(make_date({last}, 12, 25), make_date({first}, 1, 1)) + 1"
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)))), 1, 7), 16, 10).cast("int")
    start = F.date_add(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.pmod(draw, F.expr(days)).cast("int"))
    return spark.range(n).select(F.col("id").cast("int").alias("draw"), start.alias("date_from"), F.date_add(start, 6).alias("date_to"))
