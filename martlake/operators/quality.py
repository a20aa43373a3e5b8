"""Table-wide checks in place of database constraints. Each returns what violates it.

Lookups go against the keys of the looked-up side, combined within tasks before their shuffle; a hot key of
the rows that are checked can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators.lookup import anti_join, semi_join
from martlake.operators.upsert import require_keys


def check_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with NULL in a column that must be filled."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Keys holding NULL never collide."""
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(filled).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_fk(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that point at no parent. NULL points nowhere and passes."""
    known = parent.select(F.col(parent_key).alias(column))
    return anti_join(child.filter(F.col(column).isNotNull()), known, [column])


def check_restrict(removed: DataFrame, key: str, child: DataFrame, column: str) -> DataFrame:
    """Parent rows to be removed that some child still points at."""
    return semi_join(removed, child.select(F.col(column).alias(key)), [key])


def cascade(child: DataFrame, column: str, key_map: DataFrame) -> DataFrame:
    """Follow a change of parent keys, given as (old, new); other rows stay as they are.

    An old key may be given once only.
    """
    require_keys(key_map, ["old"], "key map")
    return _moved(child, column, key_map)


def _moved(child: DataFrame, column: str, key_map: DataFrame) -> DataFrame:
    moved = key_map.select(F.col("old").alias(column), F.col("new").alias("_new"))
    return (
        child.join(moved, column, "left")
        .withColumn(column, F.coalesce("_new", column))
        .select(*child.columns)
    )


def cascade_keys(tables: dict[str, DataFrame], changes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables after changes of primary keys, followed through every declared foreign key.

    ``changes`` holds (old, new) for tables with a key of one column; it is stored or small, as each child reads it again. A
    child whose own key holds the column hands the change on to the tables that point at that column. A new key must not be one
    of another row; that and two rows of one old key stop the call. Tables that are absent are passed over.
    """
    found = dict(tables)
    open_: list[tuple[str, str, DataFrame]] = []
    for name, key_map in changes.items():
        key = schemas.PRIMARY_KEYS[name]
        if len(key) != 1:
            raise ValueError(f"{name} has a key of several columns; change the tables it points at")
        require_keys(key_map, ["old"], f"key map of {name}")
        open_.append((name, key[0], key_map))
    done = set()
    for name, key, key_map in open_:
        if (name, key) not in done and name in found:
            done.add((name, key))
            found[name] = _moved(found[name], key, key_map)
            if schemas.PRIMARY_KEYS.get(name) == [key]:
                require_keys(found[name], [key], f"{name} after its change")
        for child, column, parent, parent_key in schemas.FOREIGN_KEYS:
            if (parent, parent_key) != (name, key) or child not in found or column not in found[child].columns:
                continue
            if column in schemas.PRIMARY_KEYS.get(child, []):
                # Goes on to those that point at the child, which is changed when its turn comes.
                open_.append((child, column, key_map))
            elif (child, column) not in done:
                done.add((child, column))
                found[child] = _moved(found[child], column, key_map)
    return found


def restrict_keys(tables: dict[str, DataFrame], name: str, removed: DataFrame) -> DataFrame:
    """Why rows of a table cannot be removed: (key, child, column) for every declared reference that still points at one."""
    key = schemas.PRIMARY_KEYS[name][0]
    parts = [
        check_restrict(removed.select(key), key, tables[child], column).select(key, F.lit(child).alias("child"), F.lit(column).alias("column"))
        for child, column, parent, parent_key in schemas.FOREIGN_KEYS
        if (parent, parent_key) == (name, key) and child in tables and column in tables[child].columns
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def check_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows outside the closed range. NULL passes."""
    return df.filter(~F.col(column).between(low, high))


def check_enum(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Rows with a value that is not listed. NULL passes."""
    return df.filter(~F.col(column).isin(allowed))


def check_bounds(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows no range partition takes: outside the half-open span, or NULL."""
    inside = (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))
    return df.filter(~F.coalesce(inside, F.lit(False)))


def check_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text of more bytes (UTF-8) than its column takes."""
    return df.filter(reduce(lambda a, b: a | b, [F.octet_length(c) > n for c, n in limits.items()]))


def check_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All declared constraints of the rental tables present, by name."""
    found: dict[str, DataFrame] = {}
    for name, df in tables.items():
        required = [f.name for f in schemas.OLTP[name].fields if not f.nullable and f.name in df.columns]
        found[f"{name}.not_null"] = check_null(df, required)
        keys = ([schemas.PRIMARY_KEYS[name]] if name in schemas.PRIMARY_KEYS else []) + schemas.UNIQUE_KEYS.get(name, [])
        for key in keys:
            found[f"{name}.unique({','.join(key)})"] = check_unique(df, key)
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        if child in tables and parent in tables and column in tables[child].columns:
            found[f"{child}.fk({column})"] = check_fk(tables[child], column, tables[parent], key)
    if "film" in tables:
        found["film.rating"] = check_enum(tables["film"], "rating", schemas.RATINGS)
        found["film.release_year"] = check_range(tables["film"], "release_year", *schemas.YEAR_RANGE)
    return found


def _text_key(columns: list[str]) -> Column:
    """Key columns as one text; NULL if any is, since such keys neither collide nor point anywhere."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    return F.when(~reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]), F.to_json(F.struct(*columns)))


def _marks(name: str, df: DataFrame, tables: dict[str, DataFrame], rules: dict[str, int]) -> tuple[list[Column], list[str]]:
    """What each row of a table says on the declared rules, and the rules that lack a column or table.

    Marks hold a rule's number in ``rules``, which new ones are added to.
    """
    marks, absent = [], []

    def mark(rule: str, key: Column, child: int, parent: int) -> None:
        marks.append(F.struct(F.lit(rules.setdefault(rule, len(rules))).alias("rule"), key.alias("key"), F.lit(child).alias("child"), F.lit(parent).alias("parent")))

    def lacking(rule: str, wanted: dict[str, list[str]]) -> bool:
        missing = any(t not in tables or set(columns) - set(tables[t].columns) for t, columns in wanted.items())
        if missing:
            absent.append(rule)
        return missing

    for field in schemas.OLTP[name].fields:
        rule = f"{name}.not_null({field.name})"
        if not field.nullable and not lacking(rule, {name: [field.name]}):
            mark(rule, F.when(F.col(field.name).isNull(), F.lit("")), 1, 0)
    keys = ([schemas.PRIMARY_KEYS[name]] if name in schemas.PRIMARY_KEYS else []) + schemas.UNIQUE_KEYS.get(name, [])
    for columns in keys:
        rule = f"{name}.unique({','.join(columns)})"
        if not lacking(rule, {name: columns}):
            mark(rule, _text_key(columns), 1, 0)
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        rule = f"{child}.fk({column})"
        if child == name and not lacking(rule, {child: [column], parent: [key]}):
            mark(rule, F.col(column).cast("string"), 1, 0)
        if parent == name and child in tables and column in tables[child].columns and key in df.columns:
            mark(rule, F.col(key).cast("string"), 0, 1)
    if name == "film":
        bad = {
            "rating": ~F.col("rating").isin(schemas.RATINGS),
            "release_year": ~F.col("release_year").between(*schemas.YEAR_RANGE),
        }
        for column, test in bad.items():
            if not lacking(f"film.{column}", {name: [column]}):
                mark(f"film.{column}", F.when(test, F.lit("")), 1, 0)
    return marks, absent


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of every declared constraint of the given tables: (rule, violations), NULL where a rule lacks
    its column or its parent table.

    Each table is read once. Its rows are turned into marks (rule, key), which are counted by rule and key with
    partial sums, so a hot key travels as one row per task: a unique key is violated where it is counted twice, a
    foreign key where no parent has marked it, any other rule by each mark.
    """
    parts, absent, rules = [], [], {}
    for name, df in tables.items():
        marks, lacking = _marks(name, df, tables, rules)
        absent += lacking
        if marks:
            found = df.select(F.explode(F.array(*marks)).alias("m")).select("m.*")
            parts.append(found.filter(F.col("key").isNotNull()))
    marked = reduce(DataFrame.unionByName, parts)
    # Marks are many and carry only the number of their rule, which gets its name back once they are counted.
    numbers = F.create_map(*[x for rule, k in rules.items() for x in (F.lit(k), F.lit(rule))])
    counted = marked.groupBy("rule", "key").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    counted = counted.withColumn("rule", numbers[F.col("rule")])
    broken = (
        F.when(F.col("rule").contains(".unique("), (F.col("child") > 1).cast("long"))
        .when(F.col("rule").contains(".fk("), F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
        .otherwise(F.col("child"))
    )
    totals = counted.groupBy("rule").agg(F.sum(broken).alias("violations"))
    spark = totals.sparkSession
    return totals.unionByName(spark.createDataFrame([(r, None) for r in sorted(set(absent))], "rule STRING, violations BIGINT"))
