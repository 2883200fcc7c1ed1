"""Data-quality and integrity checks (DQ1-DQ13), each a small aggregate job
whose output is a table of check rows (status OK / FAIL / NOT VERIFIED)."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.functions.columns import has_non_ascii, id_text_ok

OK, FAIL = "OK", "FAIL"


def duplicate_keys(df: DataFrame, keys, table: str) -> DataFrame:
    """DQ2/DQ11: rows beyond the first per key = rows - distinct keys. One
    partial aggregation on the key, then a global sum."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    agg = per_key.agg(F.sum("_c").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).cast("long").alias("n_keys"))
    return agg.select(F.lit(table).alias("table_name"), "n_rows", "n_keys",
                      (F.col("n_rows") - F.col("n_keys")).alias("n_duplicates"),
                      F.when(F.col("n_rows") == F.col("n_keys"), F.lit(OK))
                      .otherwise(F.lit(FAIL)).alias("status"))


def grain_check(df: DataFrame, keys, table: str) -> DataFrame:
    """DQ3: grain uniqueness; a missing key column gives NOT VERIFIED (NULL
    status and count), distinct from OK."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame(
            [(table, ",".join(keys), None, None)],
            "table_name string, grain string, n_duplicates long, status string")
    d = duplicate_keys(df, keys, table)
    return d.select("table_name", F.lit(",".join(keys)).alias("grain"), "n_duplicates", "status")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """DQ4/J9: distinct child keys absent from the parent (left anti join)."""
    pk = parent_key or key
    c = child.select(key).distinct()
    p = parent.select(F.col(pk).alias(key)).distinct()
    n = c.join(p, key, "left_anti")
    return n.agg(F.count(F.lit(1)).cast("long").alias("n_orphans"))


def non_ascii_values(df: DataFrame, cols, table: str) -> DataFrame:
    """DQ5/F7: per column, rows and distinct values with a non-ASCII char: one
    scan for all columns, and what is shuffled of a value is its sha256."""
    long = df.select(*[F.when(has_non_ascii(c), F.sha2(F.col(c), 256)).alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "digest")
    per_value = long.where(F.col("digest").isNotNull()).groupBy("column", "digest").agg(F.count(F.lit(1)).alias("n"))
    found = per_value.groupBy("column").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left").select(
        F.lit(table).alias("table_name"), "column",
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))


def id_text_check(df: DataFrame, id_col: str) -> DataFrame:
    """F16: ids rendered as text are plain integers."""
    return df.agg(F.count_if(~id_text_ok(id_col)).cast("long").alias("n_bad_ids"),
                  F.count(F.lit(1)).cast("long").alias("n_ids"))


NOT_VERIFIED = "NOT VERIFIED"
PRIMARY_KEY, PK_NOT_NULL, NOT_NULL, FOREIGN_KEY, ASCII = "primary_key", "pk_not_null", "not_null", "foreign_key", "ascii"


@dataclass(frozen=True)
class Check:
    """One constraint of one table; a foreign key names the parent's columns."""

    table: str
    constraint: str
    columns: tuple
    parent: str | None = None
    parent_columns: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.constraint}:{self.parent}" if self.parent else self.constraint


def _digests(cols) -> list[F.Column]:
    """Two 64-bit digests of a key; a null is a value of its own."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = [*cols, *[c.isNull() for c in cols]]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]


def _key_bits(df: DataFrame, columns) -> tuple[list, F.Column]:
    """A primary key as (what is digested, one bit of 64): where the last column is
    a whole number, 64 of its values under the same other columns are one digest
    and a bit each, so that a run of months leaves a row or two to be shuffled. A
    null is a digest of its own with the first bit."""
    last = columns[-1]
    if len(columns) < 2 or dict(df.dtypes)[last] not in ("tinyint", "smallint", "int", "bigint"):
        return [F.col(c) for c in columns], F.lit(1).cast("long")
    n = F.col(last).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), n.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return [*[F.col(c) for c in columns[:-1]], F.shiftright(n, 6)], F.coalesce(bit, F.lit(1).cast("long"))


_MARK = ("check", "child", "parent", "bad", "bits", "h1", "h2")


def _mark(number: int, child: int, parent: int, bad=None, key=None, bits=None, known=None) -> list[F.Column]:
    """What a row leaves of one check, in the order of ``_MARK``; none where the
    check is null."""
    zero = F.lit(0).cast("long")
    check = F.lit(number) if known is None else F.when(known, F.lit(number))
    return [check, F.lit(child).cast("long"), F.lit(parent).cast("long"), zero if bad is None else bad.cast("long"),
            F.lit(1).cast("long") if bits is None else bits, *(_digests(key) if key else (zero, zero))]


def check_tables(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """DQ6/DQ7: every constraint of every table, three-valued (OK, FAIL, NOT
    VERIFIED where a table or column is absent), one row each with rows and
    violations.

    Each table is read once: a row leaves one small mark a check (its key's
    digest, or whether it breaks a rule), marks are added up per (check, digest)
    before and after the one shuffle, and keys seen twice (more rows than bits), or
    seen in the child and not in the parent, are what is left to count."""
    spark = next(iter(tables.values())).sparkSession
    cols = {t: set(df.columns) for t, df in tables.items()}

    def present(c):
        return set(c.columns) <= cols.get(c.table, set()) and (
            c.parent is None or set(c.parent_columns) <= cols.get(c.parent, set()))
    marks: dict[str, list] = {}
    for i, c in enumerate(checks):
        if not present(c):
            continue
        nulls = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in c.columns])
        own = marks.setdefault(c.table, [])
        if c.constraint == PRIMARY_KEY:
            key, bits = _key_bits(tables[c.table], c.columns)
            own.append(_mark(i, 1, 0, key=key, bits=bits))
        elif c.constraint in (PK_NOT_NULL, NOT_NULL):
            own.append(_mark(i, 1, 0, nulls))
        elif c.constraint == ASCII:
            own.append(_mark(i, 1, 0, F.coalesce(has_non_ascii(c.columns[0]), F.lit(False))))
        else:
            own.append(_mark(i, 1, 0, key=c.columns, known=~nulls))
            marks.setdefault(c.parent, []).append(_mark(i, 0, 1, key=c.parent_columns))
    parts = [tables[t].select(F.stack(F.lit(len(m)), *[x for one in m for x in one]).alias(*_MARK)).where(F.col("check").isNotNull())
             for t, m in marks.items()]
    names = spark.createDataFrame(
        [(i, c.table, c.name, ",".join(c.columns), c.constraint, present(c)) for i, c in enumerate(checks)],
        "check int, table_name string, constraint string, columns string, kind string, present boolean")
    if parts:
        per_key = reduce(DataFrame.unionByName, parts).groupBy("check", "h1", "h2").agg(
            F.sum("child").alias("child"), F.sum("parent").alias("parent"), F.sum("bad").alias("bad"), F.bit_or("bits").alias("bits"))
        found = per_key.groupBy("check").agg(
            F.sum("child").alias("n_rows"), F.sum("bad").alias("bad"), F.sum(F.greatest(F.col("child") - F.bit_count("bits"), F.lit(0))).alias("again"),
            F.count_if((F.col("child") > 0) & (F.col("parent") == 0)).alias("orphans"))
    else:
        found = spark.createDataFrame([], "check int, n_rows long, bad long, again long, orphans long")
    out = names.join(found, "check", "left")
    count = (F.when(F.col("kind") == PRIMARY_KEY, F.col("again")).when(F.col("kind") == FOREIGN_KEY, F.col("orphans"))
             .otherwise(F.col("bad")))
    out = out.withColumn("violations", F.when(F.col("present"), F.coalesce(count, F.lit(0)).cast("long")))
    return out.select("table_name", "constraint", "columns",
                      F.when(F.col("present"), F.coalesce("n_rows", F.lit(0)).cast("long")).alias("n_rows"), "violations",
                      F.when(~F.col("present"), F.lit(NOT_VERIFIED)).when(F.col("violations") == 0, F.lit(OK)).otherwise(F.lit(FAIL)).alias("status"))


def constraint_checks(pks: dict, not_null: dict, fks: list) -> list[Check]:
    out = []
    for t, keys in pks.items():
        out += [Check(t, PRIMARY_KEY, tuple(keys)), Check(t, PK_NOT_NULL, tuple(keys))]
    out += [Check(t, NOT_NULL, (c,)) for t, cols in not_null.items() for c in cols]
    out += [Check(child, FOREIGN_KEY, (col,), parent, (pcol,)) for child, col, parent, pcol in fks]
    return out


def constraint_report(tables: dict[str, DataFrame], pks: dict, not_null: dict,
                      fks: list) -> DataFrame:
    """DQ7: PK uniqueness, NOT NULL and FK checks over a set of tables in one
    pass. One row per constraint with its violation count; the publisher refuses
    to write when any count is > 0."""
    return check_tables(tables, constraint_checks(pks, not_null, fks)).select("table_name", "constraint", "columns", "violations")


def assert_clean(report: DataFrame) -> None:
    """Raise when any constraint is violated (publish gate)."""
    bad = report.where(F.col("violations") > 0).limit(5).collect()
    if bad:
        raise ValueError(f"constraint violations: {[r.asDict() for r in bad]}")
