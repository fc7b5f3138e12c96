"""Train/test splits: R1, R2, plus layout-free and time-cutoff modes.

``randomSplit`` samples each input partition after a local sort, so its rows
depend on the partition layout (X6): feed it a persisted or written table.
:func:`hash_split` assigns every row by a hash of its key instead, so the
split is the same on any cluster, partition count or rerun after a lost
executor; it is a narrow projection + filter with no shuffle.  Its shares are
those of the hash; :func:`exact_split` gives the share to the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastry.schema import INGEST_SPLIT, KEY_COLUMNS, SEED

HASH_BUCKETS = 100


def random_split(df: DataFrame, weights=INGEST_SPLIT, seed: int = SEED) -> list[DataFrame]:
    """R1 (0.8/0.2) and R2 (0.7/0.3)."""
    return df.randomSplit(list(weights), seed)


def hash_bucket(keys=KEY_COLUMNS) -> Column:
    """0..99 from the first 32 bits of md5("store|item|date")."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % HASH_BUCKETS


def hash_split(df: DataFrame, train_pct: int = 80, keys=KEY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(keys)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


KEY_DIGITS, KEY_BITS = 4, 15
ROW_DIGITS, ROW_BITS = 4, 16


def _digits(df: DataFrame, keys, seed: int) -> list[Column]:
    """The row's place in a seeded order: 60 bits of md5("seed|store|item|date"),
    then 64 of a hash of the whole row, in digits of 15 and 16 bits."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    of_key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    of_row = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith(("map", "variant"))])
    return [
        F.shiftright(h, b * k).bitwiseAND((1 << b) - 1).cast("int")
        for h, n, b in ((of_key, KEY_DIGITS, KEY_BITS), (of_row, ROW_DIGITS, ROW_BITS)) for k in reversed(range(n))
    ]


def exact_split(df: DataFrame, share: float = INGEST_SPLIT[0], seed: int = SEED, keys=KEY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Exactly round(``share`` * n) rows, the first in a seeded order, and the rest.

    The last row of the first side is found by refining a histogram of the
    order's digits: a pass counts the rows of each value of one digit (at most
    65,536 counts come back) among the rows that agree with the digits found so
    far.  Two passes settle tables of thousands of rows, about four any table.
    Nothing is sorted, copied or shuffled but counts, and both sides are filters
    of ``df``; the same rows are chosen on any layout.  Halves round to even.

    Rows alike in every hashed column have one place; if that is the border's,
    they are counted out to the sides instead, in a range spread over tasks."""
    digits = _digits(df, keys, seed)
    names = [f"_{k}" for k in range(len(digits))]
    places = df.select(*[d.alias(n) for d, n in zip(digits, names)])
    wanted, left, border, ties = None, 0, [], 0
    for name in names:
        inside = places
        for n, v in zip(names, border):
            inside = inside.where(F.col(n) == v)
        counts = sorted(inside.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect())
        if wanted is None:
            wanted = left = round(share * sum(r["n"] for r in counts))
        if not left:  # nothing on the first side
            return df.where(F.lit(False)), df
        for value, n in counts:
            if left <= n:
                break
            left -= n
        border.append(value)
        ties = n
        if left == ties:  # the whole digit is on the first side
            break
    before, upto = F.lit(False), F.lit(True)
    for d, v in reversed(list(zip(digits, border))):
        before, upto = (d < v) | ((d == v) & before), (d < v) | ((d == v) & upto)
    if left == ties:
        return df.where(upto), df.where(~upto)
    row = df.where(upto & ~before).first()  # `ties` equal rows, of which `left` go to the first side
    same = [F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    spark = df.sparkSession
    first, second = (spark.range(k).select(*same) for k in (left, ties - left))
    return df.where(before).unionByName(first), df.where(~upto).unionByName(second)


def cutoff_split(df: DataFrame, cutoff: str, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """X11 opt-in: train on dates before ``cutoff``, test on the rest.

    Rows without a date go to the test side, so together the sides keep every row.
    """
    d, c = F.col(date_col), F.lit(cutoff).cast("date")
    return df.filter(d < c), df.filter((d >= c) | d.isNull())
