"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it owns at least 1/HOT_SHARE of a table's rows. So a table
# has at most HOT_SHARE hot keys, which bounds the broadcast list of them.
HOT_SHARE = 20_000
# Below this many rows a key fits one task without trouble.
HOT_ROWS = 100_000
# Column of a frame given for counting that says how many rows a row stands for.
WEIGHT = "rows_of_key"


@dataclass(frozen=True)
class Side:
    """A table joined to the base on the shared key.

    ``spread`` names columns that differ between rows of one key; a hot key is
    cut into pieces by their hash, so a repeated task cuts the same way.
    ``keep_base`` is a left join, otherwise an inner join. ``counted`` may name
    a cheaper frame with the same key values to count keys on. ``heavy`` is the
    stored list of the table's heavy keys (``heavy_keys``), with which nothing
    is counted. ``unique`` says that no key repeats, so there is nothing to count
    or to cut.
    """

    df: DataFrame
    spread: Sequence[str] = ()
    keep_base: bool = True
    counted: DataFrame | None = None
    unique: bool = False
    heavy: DataFrame | None = None


def _heaviest(found: DataFrame) -> DataFrame:
    """One row per key of (hot_key, n, cut, pieces): that of the table where it is heaviest.

    The list is used for every table, so it must come out the same each time it is
    computed: equal counts are decided by position.
    """
    heaviest = F.max(F.struct("n", "cut", "pieces")).alias("h")
    return found.groupBy("hot_key").agg(heaviest).select("hot_key", "h.cut", "h.pieces")


def listed_hot_keys(
    lists: dict[int, DataFrame], hot_rows: int = HOT_ROWS, share: int = HOT_SHARE
) -> DataFrame:
    """As ``hot_keys``, from stored lists of heavy keys instead of the tables."""

    def heavy(position: int, keys: DataFrame) -> DataFrame:
        limit = F.greatest(F.lit(float(hot_rows)), F.col("total") / share)
        pieces = F.ceil(F.col("n") / limit).cast("int").alias("pieces")
        return keys.filter(F.col("n") >= limit).select(
            "hot_key", "n", F.lit(position).alias("cut"), pieces
        )

    return _heaviest(reduce(DataFrame.unionByName, [heavy(i, df) for i, df in lists.items()]))


def hot_keys(
    tables: dict[int, DataFrame], key: str, hot_rows: int = HOT_ROWS, share: int = HOT_SHARE
) -> DataFrame:
    """Keys heavy in some table: the position to cut, and into how many pieces.

    Reads one column per table and counts it, with partial counts before the
    shuffle. A table with a column ``WEIGHT`` is already counted in part. The
    result has at most ``share`` keys per table.
    """

    def heavy(position: int, df: DataFrame) -> DataFrame:
        counted = WEIGHT in df.columns
        size = F.sum(WEIGHT) if counted else F.count(F.lit(1))
        columns = [F.col(key).alias("hot_key"), *([F.col(WEIGHT)] if counted else [])]
        rows = df.select(*columns).filter(F.col(key).isNotNull())
        limit = rows.agg(F.greatest(F.lit(float(hot_rows)), size / share).alias("limit")).scalar()
        counts = rows.groupBy("hot_key").agg(size.alias("n"))
        return counts.filter(F.col("n") >= limit).select(
            "hot_key",
            "n",
            F.lit(position).alias("cut"),
            F.ceil(F.col("n") / limit).cast("int").alias("pieces"),
        )

    return _heaviest(reduce(DataFrame.unionByName, [heavy(i, df) for i, df in tables.items()]))


def gathered(
    df: DataFrame, key: str, heavy: DataFrame | None, hot_rows: int = HOT_ROWS, share: int = HOT_SHARE
) -> DataFrame:
    """The rows that have a key, by key in one shuffle, if the table's list of heavy keys has no hot
    one; else as they are.

    Aggregates and joins on the key and more columns then need no shuffle of their own.
    Distinct counts would take one by all columns and one by the key. With a hot key
    they still do, as their partial sums keep it from piling up in one task.
    """
    if heavy is None or not listed_hot_keys({0: heavy}, hot_rows, share).isEmpty():
        return df
    return df.filter(F.col(key).isNotNull()).repartition(key)


def _in_pieces(
    df: DataFrame,
    key: str,
    hot: DataFrame,
    position: int,
    spread: Sequence[str],
    *extra: Column,
) -> DataFrame:
    """Add ``piece``: one piece where this table is cut, else all pieces of the key."""
    row_hash = F.xxhash64(*(spread or [key]))
    own = F.pmod(row_hash, F.col("pieces")).cast("int")
    piece = (
        F.when(F.col("cut").isNull(), F.array(F.lit(0)))
        .when(F.col("cut") == position, F.array(own))
        .otherwise(F.sequence(F.lit(0), F.col("pieces") - 1))
    )
    if position == 0:
        # A missing key meets nothing; spread such rows instead of piling them up.
        loose = F.array(F.pmod(row_hash, F.lit(HOT_SHARE)).cast("int"))
        piece = F.when(F.col(key).isNull(), loose).otherwise(piece)
    marked = df.join(F.broadcast(hot), df[key] == hot["hot_key"], "left")
    return marked.select(*df.columns, *extra, F.explode(piece).alias("piece"))


def _cut_where_found(hot: DataFrame, df: DataFrame, key: str, position: int) -> DataFrame:
    """The hot keys without those to be cut in a table that does not have them."""
    own = hot.filter(F.col("cut") == position).select(F.col("hot_key").alias(key))
    # At most as many keys as the list has.
    found = df.select(key).join(F.broadcast(own), key, "left_semi").distinct()
    found = found.select(F.col(key).alias("hot_key"), F.lit(True).alias("found"))
    marked = hot.join(F.broadcast(found), "hot_key", "left")
    return marked.filter((F.col("cut") != position) | F.col("found")).drop("found")


def star_join(
    base: DataFrame,
    key: str,
    sides: Sequence[Side],
    spread: Sequence[str],
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Join ``base`` with every side on ``key``, fan-out kept.

    Splitting a skewed partition at run time works for the outer side of a
    left join only, so a key that is heavy on the joined side would end up in
    one task. Here the table in which a hot key is heaviest is cut into pieces
    for that key and the other tables' rows of it go to all pieces. All joins
    use (key, piece), so each table is shuffled once.

    Copies of a base row that meet no row in a piece of a cut left-joined side
    are dropped: other pieces hold its matches. A key is cut by a side only if
    the side itself has it, so what ``counted`` frames say changes the balance
    and never the result. ``counted`` has the base's key column when keys may
    repeat there. Without it the base is taken as unique.

    If every side that can repeat a key has its stored list of heavy keys, no
    table is counted. Without a hot key in the lists these are plain joins, in
    which only the base can be skewed, which is split at run time.
    """
    lists = {i: side.heavy for i, side in enumerate(sides, start=1) if not side.unique}
    if counted is None and lists and all(heavy is not None for heavy in lists.values()):
        hot = listed_hot_keys(lists, hot_rows, share)
        if hot.isEmpty():
            return _plain(base, key, sides)
        return _cut_join(base, key, sides, spread, hot)
    tables = {} if counted is None else {0: counted}
    for position, side in enumerate(sides, start=1):
        if not side.unique:
            tables[position] = side.df if side.counted is None else side.counted
    if not tables:
        raise ValueError("no key can repeat in any table: plain joins will do")
    return _cut_join(base, key, sides, spread, hot_keys(tables, key, hot_rows, share))


def _plain(base: DataFrame, key: str, sides: Sequence[Side]) -> DataFrame:
    for side in sides:
        keyed = side.df.filter(F.col(key).isNotNull())
        base = base.join(keyed, key, "left" if side.keep_base else "inner")
    return base


def _cut_join(
    base: DataFrame, key: str, sides: Sequence[Side], spread: Sequence[str], hot: DataFrame
) -> DataFrame:
    for position, side in enumerate(sides, start=1):
        if side.keep_base and (side.counted is not None or side.heavy is not None):
            hot = _cut_where_found(hot, side.df, key, position)

    result = _in_pieces(base, key, hot, 0, spread, F.col("cut"))
    markers = []
    for position, side in enumerate(sides, start=1):
        markers.append(f"met_{position}")
        met = F.lit(True).alias(markers[-1])
        keyed = side.df.filter(F.col(key).isNotNull())
        right = _in_pieces(keyed, key, hot, position, side.spread, met)
        result = result.join(right, [key, "piece"], "left" if side.keep_base else "inner")
        if side.keep_base:
            spare_copy = (F.col("cut") == position) & F.col(markers[-1]).isNull()
            result = result.filter(~F.coalesce(spare_copy, F.lit(False)))
    return result.drop("piece", "cut", *markers)
