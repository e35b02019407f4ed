"""Leakage-free labels, stratified splits, class balancing and folds.

Randomness is a seeded md5 order key over (user_id, product_id): the same
digest in Spark and DuckDB, independent of partitioning, stable on re-runs and
retries. Rows of equal digest follow user and product, nulls first. Exact per-class
sizes come from exact order statistics of that key (:func:`kth_tuples`: radix
descent — no sort or shuffle of the rows); folds, which need every row's rank, use
the range-partitioned :func:`sequence_within`. Never a window partitioned by the class alone (that
would put 94 % of the rows into one task).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.columns import require_columns
from cartwise.functions.select import kth_tuples, tuple_le
from cartwise.functions.sequence import sequence_within
from cartwise.sources.schemas import TARGET_COLUMN

SEED = 42
PAIR = ("user_id", "product_id")


# ----------------------------------------------------------------------------- labels

def future_pairs(orders: DataFrame, order_products_train: DataFrame) -> DataFrame:
    """J11 + U2: distinct (user, product) bought in each user's 'train' order."""
    train_orders = orders.filter(F.col("eval_set") == "train").select("order_id", "user_id")
    return (order_products_train.select("order_id", "product_id")
            .join(train_orders, "order_id", "inner")
            .select("user_id", "product_id").distinct())


def label_pairs(features: DataFrame, future: DataFrame, only_labelled_users: bool = False,
                orders: DataFrame | None = None) -> DataFrame:
    """target = 1 when the pair is among the future pairs, else 0.

    Users without a 'train' order are kept with target 0 (the reference's
    behaviour); ``only_labelled_users=True`` restricts to users that have one
    (needs ``orders``).
    """
    pos = future.select(*PAIR).distinct().withColumn("_pos", F.lit(1))
    out = (features.join(pos, list(PAIR), "left")
           .withColumn(TARGET_COLUMN, F.coalesce(F.col("_pos"), F.lit(0)).cast("int"))
           .drop("_pos"))
    if only_labelled_users:
        if orders is None:
            raise ValueError("only_labelled_users needs the orders table")
        users = orders.filter(F.col("eval_set") == "train").select("user_id").distinct()
        out = out.join(users, "user_id", "left_semi")
    return out.select(*features.columns, TARGET_COLUMN)


# ----------------------------------------------------------------------------- quotas

def class_counts(df: DataFrame, target: str = TARGET_COLUMN) -> dict:
    """{class: rows} — one aggregation, a handful of rows to the driver."""
    return {r[0]: r[1] for r in df.groupBy(target).count().collect()}


def largest_remainder(counts: dict, k: int) -> dict:
    """Split ``k`` rows over classes in proportion to ``counts`` (floor, then the
    largest remainders get one more; ties to the lower class value)."""
    n = sum(counts.values())
    if n == 0:
        return {c: 0 for c in counts}
    base = {c: (k * m) // n for c, m in counts.items()}
    rem = {c: (k * m) % n for c, m in counts.items()}
    left = k - sum(base.values())
    for c in sorted(counts, key=lambda c: (-rem[c], c))[:left]:
        base[c] += 1
    return base


def _ranked(df: DataFrame, target: str, seed: int, salt: str, keys=PAIR,
            hold: list | None = None) -> DataFrame:
    """Rank (1..n_class) of every row within its class by the seeded hash order
    (a range-partitioned sequence; used where every row needs its rank)."""
    seed_text = f"{seed}{salt}"
    h = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in keys], F.lit(seed_text)))
    return sequence_within(df.withColumn("_h", h), [target], ["_h", *keys], rn_col="_rank",
                           hold=hold)


def _with_order(df: DataFrame, seed: int, salt: str, keys) -> tuple[DataFrame, list[str]]:
    """Seeded order key: md5 hex of ``key-...-seed`` plus its first 60 bits as a
    number (same order as the hex text; the number is what bucket counts run on)."""
    h = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in keys], F.lit(f"{seed}{salt}")))
    d = (df.withColumn("_h", h)
         .withColumn("_h60", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")))
    return d, ["_h60", "_h", *keys]


def first_per_class(df: DataFrame, quotas: dict, counts: dict, target: str = TARGET_COLUMN,
                    seed: int = SEED, salt: str = "", keys=PAIR) -> tuple[DataFrame, F.Column]:
    """Flag expression selecting the first ``quotas[c]`` rows of each class in
    seeded hash order — found by exact order statistics (no sort, no shuffle of
    the rows; see :mod:`cartwise.functions.select`)."""
    d, order = _with_order(df, seed, salt, keys)
    targets = {c: (counts[c], [q]) for c, q in quotas.items()
               if 0 < q < counts.get(c, 0)}
    kth = kth_tuples(d, order, targets, group=target) if targets else {}
    flag = F.lit(False)
    for c, q in quotas.items():
        n = counts.get(c, 0)
        if q <= 0 or n == 0:
            continue
        cond = F.lit(True) if q >= n else tuple_le(order, kth[(c, q)])
        flag = flag | ((F.col(target) == F.lit(c)) & cond)
    return d, flag


def take_per_class(df: DataFrame, quotas: dict, target: str = TARGET_COLUMN, seed: int = SEED,
                   salt: str = "", keys=PAIR, counts: dict | None = None) -> DataFrame:
    """The first ``quotas[c]`` rows of each class in seeded hash order."""
    counts = counts if counts is not None else class_counts(df, target)
    d, flag = first_per_class(df, quotas, counts, target, seed, salt, keys)
    return d.filter(flag).drop("_h", "_h60")


# ----------------------------------------------------------------------------- splits

def split_flag(df: DataFrame, test_size: float = 0.2, target: str = TARGET_COLUMN,
               seed: int = SEED, keys=PAIR) -> DataFrame:
    """Add ``is_test``; ceil(test_size·n) test rows, allocated to classes by
    largest remainder (the published counts follow this rule)."""
    require_columns(df, [target, *keys])
    counts = class_counts(df, target)
    k = math.ceil(test_size * sum(counts.values()))
    quotas = largest_remainder(counts, k)
    d, flag = first_per_class(df, quotas, counts, target, seed, "", keys)
    return d.withColumn("is_test", flag).drop("_h", "_h60")


def train_test_split(df: DataFrame, test_size: float = 0.2, target: str = TARGET_COLUMN,
                     seed: int = SEED, keys=PAIR) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, test_size, target, seed, keys)
    return (flagged.filter(~F.col("is_test")).drop("is_test"),
            flagged.filter(F.col("is_test")).drop("is_test"))


def balance_undersample(train: DataFrame, target: str = TARGET_COLUMN, seed: int = SEED,
                        keys=PAIR) -> DataFrame:
    """All positives plus as many negatives (seeded hash order); train only."""
    counts = class_counts(train, target)
    n_pos = counts.get(1, 0)
    negatives = take_per_class(train.filter(F.col(target) == 0), {0: n_pos}, target, seed,
                               ":balance", keys, counts={0: counts.get(0, 0)})
    return train.filter(F.col(target) == 1).unionByName(negatives)


def stratified_sample(df: DataFrame, size: int, target: str = TARGET_COLUMN, seed: int = SEED,
                      keys=PAIR) -> DataFrame:
    """Stratified sample of exactly min(size, n) rows."""
    counts = class_counts(df, target)
    n = sum(counts.values())
    if size >= n:
        return df
    return take_per_class(df, largest_remainder(counts, size), target, seed, ":sample", keys,
                          counts=counts)


def cv_sample(df: DataFrame, size: int = 150_000, target: str = TARGET_COLUMN,
              seed: int = SEED, keys=PAIR) -> DataFrame:
    """positives = int(size·rate), negatives = the rest; whole set if smaller."""
    counts = class_counts(df, target)
    n = sum(counts.values())
    if size >= n:
        return df
    pos = int(size * counts.get(1, 0) / n)
    return take_per_class(df, {1: pos, 0: size - pos}, target, seed, ":cv", keys, counts=counts)


def stratified_folds(df: DataFrame, k: int = 3, target: str = TARGET_COLUMN, seed: int = SEED,
                     fold_col: str = "fold", keys=PAIR, hold: list | None = None) -> DataFrame:
    """fold = (rank within class − 1) mod k — every fold holds each class in
    proportion (sizes differ by at most one per class). ``hold``: see
    :func:`sequence_within`."""
    r = _ranked(df, target, seed, ":folds", keys, hold)
    return r.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")


def plot_sample(df: DataFrame, n: int = 50_000, seed: int = SEED, keys=PAIR) -> DataFrame:
    """Seeded sample of min(n, rows) for plotting: the first n rows in hash
    order, cut at the exact n-th row (nothing is sorted or sent to one task)."""
    count = df.count()
    if n >= count:
        return df
    if n <= 0:
        return df.limit(0)
    d, order = _with_order(df, seed, "", keys)
    kth = kth_tuples(d, order, {None: (count, [n])})
    return d.filter(tuple_le(order, kth[(None, n)])).drop("_h", "_h60")


def seeded_shuffle(df: DataFrame, seed: int = SEED, keys=PAIR, position: str = "position",
                   hold: list | None = None) -> DataFrame:
    """All rows in seeded random order, as their place 1..n in it. Written with
    ``repartitionByRange(position)`` the files hold the shuffled order; no task
    sorts more than its range. ``hold``: see :func:`sequence_within`."""
    h = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in keys], F.lit(f"{seed}:shuffle")))
    return sequence_within(df.withColumn("_h", h), [], ["_h", *keys], rn_col=position, hold=hold).drop("_h")
