"""Data contracts: rules given as a table, checked in one pass, with a quarantine.

A rule is (rule, column, kind, low, high, pattern, allowed, other).  Kinds:

* ``present``: the column is not null (nor NaN, nor blank text);
* ``range``: between ``low`` and ``high``, either may be open (dates and times count as seconds since 1970);
* ``pattern``: the whole text fits ``pattern``;
* ``allowed``: the value, as text, is one of ``allowed``;
* ``not_after``: not greater than the column ``other``;
* ``unique``: no other row has the same value.

All kinds but ``present`` let null pass, so a missing value breaks one rule and not several.  The rules are compiled into one
integer per row, bit k for the k-th rule by name, in one projection; ``unique`` adds the values that come more than once, which are
counted with partial sums, joined back.  :func:`checked` keeps every row, so accepted and quarantined rows together are the input.

:func:`hampel` judges a series' days by a sliding window: a value further than ``limit`` scaled median deviations from
the window's median is an outlier.  Both medians are order statistics of the window (the lower one of an even number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessera import schema as S

RULES = ("rule string, column string, kind string, low double, high double, pattern string, allowed array<string>, "
         "other string")
KINDS = ("present", "range", "pattern", "allowed", "not_after", "unique")
MOST_RULES = 62
SCALE = 1.4826  # median deviation to standard deviation of a normal distribution


def rule(name: str, column: str, kind: str, low: float | None = None, high: float | None = None, pattern: str | None = None,
         allowed: list[str] | None = None, other: str | None = None) -> tuple:
    return name, column, kind, low, high, pattern, allowed, other


def rule_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)


def _number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double") * 86400
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    return c.cast("double")


def _broken(r, kind: T.DataType) -> Column:
    """Whether a row breaks the rule (never null)."""
    c = F.col(f"`{r['column']}`")
    if r["kind"] == "present":
        lost = c.isNull()
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            lost = lost | F.isnan(c)
        return lost | (F.trim(c) == "") if isinstance(kind, T.StringType) else lost
    if r["kind"] == "range":
        x = _number(c, kind)
        out = F.lit(False)
        for bound, beyond in ((r["low"], lambda b: x < b), (r["high"], lambda b: x > b)):
            out = out if bound is None else out | beyond(F.lit(bound))
    elif r["kind"] == "pattern":
        out = ~c.cast("string").rlike(f"\\A(?:{r['pattern']})\\z")
    elif r["kind"] == "allowed":
        out = ~c.cast("string").isin(list(r["allowed"]))
    else:
        out = c > F.col(f"`{r['other']}`")
    return F.coalesce(out, F.lit(False))


def checked(rows: DataFrame, rules: DataFrame, out: str = "broken") -> tuple[DataFrame, list[str]]:
    """``rows`` with the bits of the broken rules in ``out`` (0: none), and the rules' names in the order of their bits.

    The rules are a short list by nature, at most ``MOST_RULES``; they are read by the driver to be compiled.
    """
    own = sorted(rules.limit(MOST_RULES + 1).collect(), key=lambda r: r["rule"])
    if len(own) > MOST_RULES or len({r["rule"] for r in own}) < len(own):
        raise ValueError(f"rules need different names, and there may be {MOST_RULES} of them")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    for r in own:
        if r["kind"] not in KINDS or r["column"] not in kinds or (r["kind"] == "not_after" and r["other"] not in kinds):
            raise ValueError(f"rule {r['rule']}: unknown kind or column")
    bits = F.lit(0).cast("long")
    for k, r in enumerate(own):
        if r["kind"] != "unique":
            bits = bits.bitwiseOR(F.when(_broken(r, kinds[r["column"]]), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    got = rows.withColumn(out, bits)
    for k, r in enumerate(own):
        if r["kind"] == "unique":
            twice = rows.where(F.col(f"`{r['column']}`").isNotNull()).groupBy(F.col(f"`{r['column']}`").alias("_value")) \
                .agg(F.count("*").alias("_n")).where("_n > 1").select("_value")
            got = got.join(twice, F.col(f"`{r['column']}`") == F.col("_value"), "left") \
                .withColumn(out, F.col(out).bitwiseOR(F.when(F.col("_value").isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))) \
                .drop("_value")
    return got, [r["rule"] for r in own]


def names_of(broken: Column, rules: list[str]) -> Column:
    """The names of the rules whose bits are set."""
    return F.filter(F.array(*[F.when(broken.bitwiseAND(F.lit(1 << k)) != 0, F.lit(n)) for k, n in enumerate(rules)]), lambda x: x.isNotNull()) \
        if rules else F.array().cast("array<string>")


def accepted(marked: DataFrame, out: str = "broken") -> DataFrame:
    return marked.where(F.col(out) == 0).drop(out)


def quarantined(marked: DataFrame, rules: list[str], out: str = "broken") -> DataFrame:
    """The rows that break a rule, with the bits and the rules' names."""
    return marked.where(F.col(out) != 0).withColumn(f"{out}_rules", names_of(F.col(out), rules))


def hampel(panel: DataFrame, y: str = S.Y, half: int = 7, limit: float = 3.0) -> DataFrame:
    """``panel`` with median, deviation (scaled) and is_outlier of the window of ``half`` rows on either side.

    Rows without a value are no outliers and not part of windows; where half the window is one value, any other is an outlier.
    """
    def middle(values):
        return F.element_at(values, F.ceil(F.size(values) / 2).cast("int"))
    w = W.partitionBy(S.SERIES).orderBy(S.DT).rowsBetween(-half, half)
    c = F.col(y).cast("double")
    rows = panel.withColumn("_near", F.sort_array(F.collect_list(F.when(~F.isnan(c), c)).over(w)))
    rows = rows.withColumn("median", middle(F.col("_near")))
    gaps = F.sort_array(F.transform("_near", lambda v: F.abs(v - F.col("median"))))
    rows = rows.withColumn("deviation", F.lit(SCALE) * middle(gaps)).drop("_near")
    return rows.withColumn("is_outlier", F.coalesce(~F.isnan(c) & (F.abs(c - F.col("median")) > limit * F.col("deviation")), F.lit(False)))
