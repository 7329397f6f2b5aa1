"""Full outer merge of two tables, taking each shared column from the first that has it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe_keys: Sequence[str] = ()) -> DataFrame:
    """Full join on ``keys`` (plain equality) and ``null_safe_keys``; shared columns are coalesced.

    Keys should identify rows closely (a page view, an org): a coarse key would fan out.
    """
    right_names = {c: f"__r_{c}" for c in right.columns}
    renamed = right.withColumnsRenamed(right_names)
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(right_names[k]))
    for k in null_safe_keys:
        on = on & F.col(k).eqNullSafe(F.col(right_names[k]))
    joined = left.join(renamed, on, "full")
    out = []
    for c in left.columns:
        out.append(F.coalesce(F.col(c), F.col(right_names[c])).alias(c) if c in right_names else F.col(c))
    out += [F.col(n).alias(c) for c, n in right_names.items() if c not in left.columns]
    return joined.select(*out)


LEFT, RIGHT = "left", "right"


def merge_matches(
    joined: DataFrame,
    side: str,
    matched_by: Sequence[str],
    keys: Sequence[str],
    base: Sequence[str],
    left: Sequence[str],
    right: Sequence[str],
    *,
    place: Sequence[str],
) -> DataFrame:
    """:func:`full_merge` of two look-ups of the same rows, ``distinct``, without joining them.

    ``joined`` is a left join of rows with the columns ``base`` to the union of two tables;
    ``side`` says which one a match is of, ``LEFT`` (columns ``left``) or ``RIGHT`` (columns
    ``right``), null without a match. The result has the distinct rows of a ``full_merge`` on
    ``keys`` of a left join to the first table and an inner join to the second, and in
    ``side`` whether the first has part in a row (null if not).

    ``matched_by`` are columns a row's matches depend on alone. ``keys`` are ``base`` columns
    but the last, an id in both tables. Where ``place`` and ``matched_by`` include what
    ``joined`` is partitioned by, nothing is shuffled.
    """
    own, match = F.col(side), F.col(keys[-1])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    columns = list(dict.fromkeys([*base, *right]))
    part = F.struct(*[F.col(c) for c in columns if c not in keys[:-1]])
    near = [*place, *matched_by]
    same = Window.partitionBy(*near, *[k for k in keys[:-1] if k not in near], match)
    # The second window's order begins that of the first, so rows are sorted once.
    paired = joined.withColumns(
        {
            "__pairs": F.collect_set(F.when((own == RIGHT) & known, part)).over(same),
            "__met": F.max((own == LEFT) & known).over(same),
        }
    ).withColumn("__first_has", F.coalesce(F.max(own == LEFT).over(Window.partitionBy(*near)), F.lit(False)))
    is_right = F.coalesce(own == RIGHT, F.lit(False))
    none = F.array(F.lit(None).cast(paired.schema["__pairs"].dataType.elementType))
    nothing = F.slice(none, 1, 0)
    alone = F.concat(
        # A match of the second table that met none of the first, and a row without any in the first.
        F.when(F.coalesce("__met", F.lit(False)), nothing).otherwise(F.array(part)),
        F.when(F.col("__first_has"), nothing).otherwise(none),
    )
    pairs = F.when(known & (F.size("__pairs") > 0), F.col("__pairs")).otherwise(none)
    each = paired.withColumn("__other", F.explode(F.when(is_right, alone).otherwise(pairs)))
    other, mine = F.col("__other"), ~is_right

    def merged(c: str):
        if c in keys[:-1]:
            return F.col(c)
        if c in base:
            return F.coalesce(F.col(c), other[c]).alias(c)
        if c not in left:
            return other[c].alias(c)
        value = F.when(mine, F.col(c))
        return (F.coalesce(value, other[c]) if c in right else value).alias(c)

    first_part = F.when(mine | other.isNull(), F.lit(LEFT)).alias("__part")
    placed = [F.col(c).alias(f"__place{i}") for i, c in enumerate(near)]
    out = list(dict.fromkeys([*base, *left, *right]))
    # Equal rows have one place, so with it in the key they are already together.
    found = each.select(*[merged(c) for c in out], first_part, *placed).distinct()
    return found.select(*out, F.col("__part").alias(side))
