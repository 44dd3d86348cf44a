"""Give every row what is known about its group, however large one group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group is hot from this share of the rows on, so at most so many are hot.
HOT_SHARE = 2000


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` join ``groups``, which has one row per key and counts its rows in ``size``.

    ``total`` is the number of rows; ``how`` is ``inner`` or ``left``. Groups of more
    than 1/2000 of the rows are fewer than 2000 and are broadcast; all others meet
    their rows in a shuffle, where none of them stands out. Both tables are read
    twice, so they should be stored.
    """
    bound = max(total // HOT_SHARE, 1)
    hot = F.broadcast(groups.where(F.col(size) > bound))
    marked = rows.join(hot, keys, "inner")
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(F.col(size) <= bound), keys, how)
    return marked.unionByName(rest)
