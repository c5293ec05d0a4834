"""Open nested JSON to flat columns.

Two passes: one finds every path with the type of its first value (a small aggregate), the
other is a single projection. Both stay in the JVM. Object keys and array positions join
with a double underscore; booleans stay booleans and every other leaf becomes text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vigil.sources.naming import distinct_names

MAX_DEPTH = 6
SEPARATOR = "__"
_STEP = "\u0001"  # between steps; each step starts with k (object key) or i (array index)
_MAP, _ARRAY = "map<string,variant>", "array<variant>"
# Pieces of JSON text other than whole numbers with a point. Nothing is given back, so a
# text is read once.
_OTHER = (
    r'[^"0-9-]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    r"|(?!-?[0-9]+\.0+(?![0-9eE]))-?[0-9][0-9.eE+-]*+"
)


@dataclass(frozen=True)
class Leaf:
    steps: tuple[str, ...]
    is_boolean: bool  # type of the first value seen
    has_container: bool  # an empty or too deep container stood here in some record

    @property
    def path(self) -> str:
        return SEPARATOR.join(s[1:] for s in self.steps)


def exact_json(text: Column) -> Column:
    """JSON text with every whole number that has a point (`1.0`) put in a string of its own
    kind; null if there is none. VARIANT drops the zeros, so `1.0` and `1` would be the same."""
    marked = F.regexp_replace(
        text, rf"\G((?:{_OTHER})*+)(-?[0-9]+\.0)0*(?![0-9eE])", r'$1"\\u0001$2"'
    )
    return F.when(text.rlike(r"[0-9]\.0"), marked)


def record_hash(record: Column, exact: Column | None = None) -> Column:
    """md5 of the record with sorted keys: key order does not matter, values do.

    `exact` is the record as parsed from `exact_json`, or null.
    """
    return F.md5(F.to_json(record if exact is None else F.coalesce(exact, record)))


def _is_container(v: Column) -> Column:
    return v.try_cast(_MAP).isNotNull() | v.try_cast(_ARRAY).isNotNull()


def leaf_rows(records: DataFrame, record: str, order: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per leaf: `order`, `steps` (text) and `value`.

    Each round opens one level; what is not a filled container passes through unchanged.
    """
    tvf = records.sparkSession.tvf
    rows = records.select(order, F.lit("").alias("steps"), F.col(record).alias("value"))
    for _ in range(max_depth + 1):
        opened = tvf.variant_explode_outer(F.col("value").outer()).toDF("pos", "key", "child")
        name = F.coalesce(F.concat(F.lit("k"), "key"), F.concat(F.lit("i"), F.col("pos").cast("string")))
        rows = rows.lateralJoin(opened).select(
            order,
            F.when(F.col("pos").isNull(), F.col("steps"))
            .otherwise(F.concat("steps", F.lit(_STEP), name))
            .alias("steps"),
            F.coalesce("child", "value").alias("value"),
        )
    return rows.select(order, F.substring("steps", 2, 2**31 - 1).alias("steps"), "value")


def leaf_types(records: DataFrame, record: str, order: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Distinct leaf paths: first type by `order` (null counts as text), first position."""
    v = F.col("value")
    return (
        leaf_rows(records, record, order, max_depth)
        .groupBy("steps")
        .agg(
            F.min_by(F.schema_of_variant(v) == "BOOLEAN", order).alias("is_boolean"),
            F.max(_is_container(v)).alias("has_container"),
            F.min(order).alias("first_seen"),
        )
    )


def discover(records: DataFrame, record: str, order: str, max_depth: int = MAX_DEPTH) -> list[Leaf]:
    """The leaves on the driver, first seen first. Their number is that of the columns."""
    rows = leaf_types(records, record, order, max_depth).orderBy("first_seen", "steps").collect()
    if any(not r.steps for r in rows):
        raise ValueError("a record is not a JSON object")
    return [Leaf(tuple(r.steps.split(_STEP)), bool(r.is_boolean), r.has_container) for r in rows]


def _get(record: Column, steps: tuple[str, ...], kind: str) -> Column:
    """The value at a path as `kind`, null where the path is missing."""
    if all(s[1:] and not ("'" in s and '"' in s) for s in steps):
        return F.try_variant_get(record, "$" + "".join(map(_path_step, steps)), kind)
    out = record  # keys a path cannot spell
    for s in steps:
        out = (
            F.try_element_at(out.try_cast(_MAP), F.lit(s[1:]))
            if s[0] == "k"
            else F.get(out.try_cast(_ARRAY), int(s[1:]))
        )
    return F.try_variant_get(out, "$", kind)


def _path_step(step: str) -> str:
    if step[0] == "i":
        return f"[{step[1:]}]"
    quote = "'" if '"' in step else '"'
    return f"[{quote}{step[1:]}{quote}]"


def leaf_text(record: Column, leaf: Leaf, guarded: bool, max_depth: int = MAX_DEPTH) -> Column:
    """Text of a leaf. A container below the depth cap is no leaf and gives null."""
    text = _get(record, leaf.steps, "string")
    if guarded and len(leaf.steps) <= max_depth:
        return F.when(~_is_container(_get(record, leaf.steps, "variant")), text)
    return text


def flat_columns(
    record: Column,
    leaves: list[Leaf],
    names: dict[str, str],
    types: dict[str, str],
    max_depth: int = MAX_DEPTH,
) -> tuple[dict[str, Column], Column]:
    """Output columns by name, and the values that fit none of them as JSON text.

    `names` maps paths to columns, `types` columns to boolean or string. A value that is
    no boolean in a boolean column is rescued, as is a second value for the same path.
    """
    inner = {leaf.steps[:i] for leaf in leaves for i in range(1, len(leaf.steps))}
    by_path: dict[str, list[Column]] = {}
    for leaf in leaves:
        guarded = leaf.has_container or leaf.steps in inner
        by_path.setdefault(leaf.path, []).append(leaf_text(record, leaf, guarded, max_depth))
    columns: dict[str, Column] = {}
    rescued: list[Column] = []

    def rescue(path: str, text: Column, condition: Column) -> None:
        entry = F.struct(F.lit(path).alias("key"), text.alias("value"))
        rescued.append(F.when(condition & text.isNotNull(), entry))

    for path, texts in by_path.items():
        text = F.coalesce(*texts)
        for i, other in enumerate(texts[1:], 1):
            rescue(path, other, F.coalesce(*texts[:i]).isNotNull())
        if types[names[path]] == "boolean":
            flag = text.try_cast("boolean")
            rescue(path, text, flag.isNull())
            text = flag
        columns[names[path]] = text
    return columns, _rescued_json(rescued)


def _rescued_json(entries: list[Column]) -> Column:
    if not entries:
        return F.lit(None).cast("string")
    any_left = reduce(Column.__or__, (e.isNotNull() for e in entries))
    kept = F.array_compact(F.array(*entries))
    return F.when(any_left, F.to_json(F.map_from_entries(kept)))


def flatten(records: DataFrame, record: str, order: str, keep: list[str], max_depth: int = MAX_DEPTH) -> DataFrame:
    """`keep` columns plus one column per leaf path, named by its sanitised path."""
    leaves = discover(records, record, order, max_depth)
    names = distinct_names([leaf.path for leaf in leaves], {})
    types: dict[str, str] = {}
    for leaf in leaves:
        types.setdefault(names[leaf.path], "boolean" if leaf.is_boolean else "string")
    columns, rescued = flat_columns(F.col(record), leaves, names, types, max_depth)
    return records.select(
        *keep, *(c.alias(n) for n, c in columns.items()), rescued.alias("_rescued_data")
    )
