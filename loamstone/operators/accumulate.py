"""Keyed rows that grow: sets and counters on upsert, bounded histories, filled templates, aliases, and checks of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def accumulated(
    stored: DataFrame | None, new: DataFrame, keys: list[str], sets: Sequence[str] = (), greatest: Sequence[str] = (), sums: Sequence[str] = (), first: Sequence[str] = (), order: str | None = None
) -> DataFrame:
    """One row per key after an upsert: `sets` (arrays) hold the sorted union of their elements, `greatest` the greatest
    value, `sums` the sum, `first` the value of the least `order` (stored rows before new ones), which is kept as well.

    Elements are aggregated one by one, never as arrays of arrays: a key with very many rows is reduced on the map side to
    its different elements. Null arrays count as empty, null elements are left out; null counters count as 0.
    """
    first = [*first, *([order] if order and order not in first else [])]
    columns = [*keys, *sets, *greatest, *sums, *first]
    both = new.select(*columns, F.lit(1).alias("_age"))
    if stored is not None:
        both = stored.select(*columns, F.lit(0).alias("_age")).unionByName(both)
    place = F.struct("_age", *([order] if order else []))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = both.groupBy(*keys).agg(
        *[F.max(zero(c)).alias(c) for c in greatest], *[F.sum(zero(c)).alias(c) for c in sums], *[F.min_by(c, place).alias(c) for c in first],
        F.count("*").alias("_rows"),
    ).drop("_rows")
    for c in sets:
        elements = both.select(*keys, F.explode(c).alias("_e")).where("_e IS NOT NULL").distinct()
        union = elements.groupBy(*keys).agg(F.array_sort(F.collect_list("_e")).alias(c))
        out = out.join(union, keys, "left").withColumn(c, F.coalesce(c, F.array().cast(new.schema[c].dataType)))
    return out


def history(stored: DataFrame | None, new: DataFrame, keys: list[str], time: str, n: int = 10) -> DataFrame:
    """The last n rows of each key after new rows are appended: a log that keeps its end."""
    both = new if stored is None else stored.unionByName(new)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time)))
    return both.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")


def first_of(columns: Sequence[Column]) -> Column:
    """The first of the values that is neither null nor blank: alternative names of one field."""
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", c) for c in columns])


def aliased(df: DataFrame, fields: dict[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """A projection that takes each field from the first of its alternative columns that holds something; names that df does
    not have are passed over. Rows that lack a required field are left out."""
    missing = F.lit(None).cast("string")
    have = set(df.columns)
    out = df.select(*[first_of([F.col(f"`{c}`") for c in names if c in have] or [missing]).alias(k) for k, names in fields.items()])
    for c in required:
        out = out.where(F.col(c).isNotNull())
    return out


def filled(value: Column, template: Column) -> Column:
    """The value, or the template's where it is null, blank, zero, false or an empty array."""
    text = value.cast("string")
    return F.when(value.isNull() | text.isin("", "0", "0.0", "false", "[]"), template).otherwise(value)


def overridden(row: Column, changes: Column, fields: Sequence[str]) -> Column:
    """A struct whose named fields are replaced by those of `changes` that hold something."""
    for f in fields:
        row = row.withField(f, F.coalesce(F.when(F.trim(changes[f].cast("string")) != "", changes[f]), row[f]))
    return row


def row_errors(checks: dict[str, Column]) -> Column:
    """The names of the checks that a row fails, in the order given; a null check fails."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def appended(items: Column, item: Column) -> Column:
    """The array with the item at its end, unless it holds it in any letter case; order is kept."""
    items = F.coalesce(items, F.array().cast("array<string>"))
    known = F.exists(items, lambda x: F.lower(x) == F.lower(item))
    return F.when(item.isNull() | known, items).otherwise(F.concat(items, F.array(item)))


def rotation(queries: DataFrame, key: str, last_run: str, n: int) -> DataFrame:
    """The n rows whose turn it is: those that never ran, then those whose last run is longest ago; ties by key."""
    return queries.orderBy(F.asc_nulls_first(last_run), F.col(key)).limit(n)


def frontier(pages: DataFrame, url: str, depth: str, score: str, most_depth: int, most_pages: int) -> DataFrame:
    """The pages to visit next: each address once at its least depth (of these the best score), ordered by depth, then from
    the best score, then by address, at most most_pages of them and none deeper than most_depth."""
    once = pages.where(F.col(depth) <= most_depth).groupBy(url).agg(F.min(F.struct(F.col(depth), -F.col(score))).alias("_r"))
    rows = once.select(url, F.col(f"_r.{depth}").alias(depth), (-F.col("_r.col2")).alias(score))
    return rows.orderBy(depth, F.desc(score), url).limit(most_pages)


def entries(df: DataFrame, column: str, value: str, key: str = "key") -> DataFrame:
    """The entries of a JSON object in a text column as rows (other columns, key, value); null and broken texts give none.
    `value` is the DDL type of the values."""
    kept = [c for c in df.columns if c != column]
    parsed = F.from_json(F.col(column), f"map<string,{value}>")
    return df.select(*kept, F.explode(parsed).alias(key, "value"))
