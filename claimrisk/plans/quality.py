"""Declarative data tests; every test yields rows of (table_name, test, column_name, failures)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import all_of
from claimrisk.schemas import CLAIM_GRAIN, TIERS
from claimrisk.session import store

# The places of service a claim may have.
PLACES = ["F", "O"]


def grain_counts(df: DataFrame, grain=CLAIM_GRAIN) -> DataFrame:
    """Rows per grain as ``n``; the tests of a table on its grain columns follow from one such scan."""
    return df.groupBy(*grain).agg(F.count("*").alias("n"))


def column_tests(df: DataFrame, table: str, not_null=(), accepted=None, rows=None) -> DataFrame:
    """Not-null and accepted-values tests of one table in one scan; NULL is an accepted value.

    ``rows`` names a column that says how many rows of the table a row of ``df`` stands for.
    """
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("accepted_values", c, ~F.col(c).isin(values)) for c, values in (accepted or {}).items()]
    number = F.lit(1) if rows is None else F.col(rows)
    counted = df.agg(*[F.coalesce(F.sum(F.when(failed, number)), F.lit(0)).cast("long").alias(f"t{i}")
                       for i, (_, _, failed) in enumerate(tests)])
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(test).alias("test"),
                 F.lit(column).alias("column_name"), F.col(f"t{i}").alias("failures"))
        for i, (test, column, _) in enumerate(tests)])
    return counted.select(F.inline(rows))


def unique(df: DataFrame, table: str, columns, rows=None) -> DataFrame:
    """Number of keys that occur more than once; keys with a NULL part are ignored."""
    known = df.filter(all_of(F.col(c).isNotNull() for c in columns))
    counts = grain_counts(known, columns) if rows is None else known.groupBy(*columns).agg(
        F.sum(rows).alias("n"))
    return _result(counts.filter("n > 1"), table, "unique", "+".join(columns), F.count("*"))


def relationships(child: DataFrame, parent: DataFrame, table: str, column: str,
                  parent_column=None, rows=None) -> DataFrame:
    """Child rows whose key is missing in the parent; each key is looked up once."""
    number = F.count("*") if rows is None else F.sum(rows)
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(number.alias("n"))
    known = parent.select(F.col(parent_column or column).alias(column)).distinct()
    orphans = keys.join(known, column, "left_anti")
    return _result(orphans, table, "relationships", column, F.coalesce(F.sum("n"), F.lit(0)))


def _result(df, table, test, column, failures):
    return df.agg(failures.alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(test).alias("test"),
        F.lit(column).alias("column_name"), "failures")


def run_tests(staging: DataFrame, mart: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """All tests of the SQL models, and of the score table when given; staging is scanned once."""
    grains = store(grain_counts(staging))
    results = [
        column_tests(grains, "stg_cms_claims", ["provider_id", "procedure_code"],
                     {"place_of_service": PLACES}, rows="n"),
        column_tests(mart, "fct_provider_risk", ["provider_id"], {"risk_tier": TIERS}),
        unique(mart, "fct_provider_risk", ["provider_id"]),
        unique(grains, "stg_cms_claims", CLAIM_GRAIN, rows="n"),
        relationships(grains, mart, "stg_cms_claims", "provider_id", rows="n"),
    ]
    if scores is not None:
        results.append(column_tests(scores, "ml_provider_scores", ["risk_score"]))
    return reduce(DataFrame.unionByName, results)
