"""Query registry: Spark callable plus, where SQL can say it, the check query."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.operators import ranking
from lakerisk.operators.scoring import score_and_level
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; ``sql`` may use the oracle views."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle.sql(sql)
        return function

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def history(spark: SparkSession, d: str) -> DataFrame:
    return M.event_history(D.survey(spark, d), D.units(spark, d))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """The log with the score of each event, before any join."""
    return score_and_level(D.survey(spark, d), "_saat_itu")


def latest(spark: SparkSession, d: str) -> DataFrame:
    return M.latest_with_place(D.survey(spark, d), D.units(spark, d))


def gold(spark: SparkSession, d: str) -> DataFrame:
    """Per-unit gold columns with the rule prediction."""
    units = D.units(spark, d)
    return M.gold_units(M.latest_with_place(D.survey(spark, d), units), units)


def ranked(spark: SparkSession, d: str) -> DataFrame:
    return ranking.priority_rank(gold(spark, d))


def pick(df: DataFrame, cols: Sequence[str], *round_cols: str) -> DataFrame:
    return rounded(df.select(*cols), *round_cols)
