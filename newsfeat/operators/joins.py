"""Equi-joins that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.session import stored

# Bounds for sending a side to every executor, and the row count from which a key counts
# as hot, which is also the size of its slices.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
HOT_ROWS = 1_000_000

# The list of hot keys is never longer than this, and the summary that finds them counts so many keys at once.
HOT_KEYS, TRACKED_KEYS = 10_000, 65_536

# A bitmap of keys has 16 bits a key, in pages, and never more than these pages (16 MB); a fuller one is not made.
PAGE_BITS, MAX_PAGES = 32_768, 4_096

_SALT, _SLICES, _ROWS = "__salt", "__slices", "__rows"


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
    return F.lit(16)


def fits(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Measure rows and bytes of a side; run it on stored tables, not on long lineages."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    if max_rows <= 0:
        return False
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def _no_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def hot_keys(big: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """keys, slices of the keys with more than `hot_rows` rows, or None; at most HOT_KEYS rows whatever the data.

    A frequent-items summary of fixed size is kept per task and merged; only keys it names are counted exactly. It
    may miss a key that holds under a few hundred-thousandths of all rows, which is less than a task's share.
    """
    place = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    known = big.where(_no_null(keys)).select(*[F.col(f"`{k}`") for k in keys], place.alias("__place"))
    tracked = max(TRACKED_KEYS, HOT_KEYS)
    top = known.agg(F.call_function("approx_top_k", F.col("__place"), F.lit(HOT_KEYS), F.lit(tracked)).alias("top")).first()
    often = [r["item"] for r in top["top"] if r["count"] > hot_rows]
    if not often:
        return None
    counted = known.where(F.col("__place").isin(often)).groupBy(*keys).agg(F.count("*").alias("n")).where(
        F.col("n") > hot_rows).select(*keys, F.ceil(F.col("n") / hot_rows).cast("int").alias(_SLICES))
    # as values: both sides of a join must see the same slices, also when a task runs again
    return big.sparkSession.createDataFrame(counted.limit(HOT_KEYS).collect(), counted.schema)


def key_bitmap(small: DataFrame, big: DataFrame, keys: list[str]) -> DataFrame | None:
    """page, bits of the keys of `small`; None where one of bounded size would say nothing or the sides hash differently."""
    plain = (T.IntegralType, T.StringType, T.BinaryType, T.DateType, T.TimestampType)
    kinds = [(small.schema[k].dataType, big.schema[k].dataType) for k in keys]
    if any(a != b or not isinstance(a, plain) for a, b in kinds):
        return None
    known = small.select(*keys).where(_no_null(keys)).distinct()
    pages = 1 + 16 * known.count() // PAGE_BITS
    if pages > 4 * MAX_PAGES:  # more than a quarter of the bits would be set
        return None
    pages = min(pages, MAX_PAGES)
    slot = _slot(keys, pages)
    bits = known.select(slot.alias("slot")).groupBy(F.expr(f"slot div {PAGE_BITS}").alias("__page")).agg(
        F.expr(f"bitmap_construct_agg(slot % {PAGE_BITS})").alias("__bits"))
    every = small.sparkSession.range(pages).select(F.col("id").alias("__page"))
    return stored(every.join(bits, "__page", "left"), "key-bitmap")


def _slot(keys: list[str], pages: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(PAGE_BITS * pages))


def with_hit(big: DataFrame, bitmap: DataFrame, keys: list[str], name: str = "__hit") -> DataFrame:
    """Rows with a flag that is false only where the key is surely not among those of the bitmap."""
    slot = _slot(keys, bitmap.count())
    marked = big.withColumn("__slot", slot).withColumn("__page", F.expr(f"__slot div {PAGE_BITS}"))
    byte = F.conv(F.hex(F.expr(f"substring(__bits, cast((__slot % {PAGE_BITS}) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(__slot % 8 as int))")) != 0
    out = marked.join(F.broadcast(bitmap), "__page", "left").withColumn(name, F.coalesce(hit, F.lit(False)) & _no_null(keys))
    return out.select(*[F.col(f"`{c}`") for c in big.columns], name)


def _spread(big: DataFrame, smalls: list[DataFrame], keys: list[str], spread: list[str] | None,
            hot_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Cut the rows of hot keys into slices and copy the matching small rows to each slice.

    A key gets one slice per `hot_rows` rows, so slices stay alike however large the key; the list of hot keys
    has a fixed length. Slices come from a hash of the other columns (or `spread`), so a rerun task gives
    the same ones. Rows with a null key match nothing and may go anywhere.
    """
    found = hot_keys(big, keys, hot_rows)
    nobody = big.select(*keys, F.lit(1).alias(_SLICES)).where(F.lit(False))
    hot = F.broadcast(nobody if found is None else found)
    others = spread or [c for c in big.columns if c not in keys] or keys
    place = F.xxhash64(*[F.col(f"`{c}`") for c in others])
    some_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    slices = F.when(some_null, F.lit(2**30)).otherwise(F.coalesce(_SLICES, F.lit(1)))
    big = (
        big.join(hot, keys, "left")
        .withColumn(_SALT, F.pmod(place, slices).cast("int"))
        .drop(_SLICES)
    )
    copies = F.sequence(F.lit(0), F.coalesce(_SLICES, F.lit(1)) - 1)
    smalls = [
        s.join(hot, keys, "left").withColumn(_SALT, F.explode(copies)).drop(_SLICES) for s in smalls
    ]
    return big, smalls


def _join_counted(big: DataFrame, small: DataFrame, keys: list[str], how: str, hot_rows: int) -> DataFrame:
    """Join a frame that has nothing but its keys: join each key once, then repeat it.

    The repeats of a key are made in slices of `hot_rows` rows, dealt over the tasks.
    """
    joined = big.groupBy(*keys).agg(F.count("*").alias(_ROWS)).join(small, keys, how)
    names = [F.col(f"`{c}`") for c in joined.columns if c != _ROWS]
    last = F.ceil(F.col(_ROWS) / hot_rows).cast("int") - 1
    slices = joined.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
    rows = F.least(F.lit(hot_rows), F.col(_ROWS) - F.col(_SALT).cast("long") * hot_rows).cast("int")
    # a stated number: adaptive execution would merge the slices, which are small until they are repeated
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slices.withColumn(_ROWS, rows).repartition(parts, *keys, _SALT)
    return dealt.withColumn(_ROWS, F.explode(F.sequence(F.lit(1), F.col(_ROWS)))).select(*names)


def lookup_join(big: DataFrame, small: DataFrame, keys: str | list[str], how: str = "inner", *,
                spread: list[str] | None = None, max_rows: int | None = None,
                hot_rows: int = HOT_ROWS, small_fits: bool | None = None, derived: bool = False,
                sieve: bool = True) -> DataFrame:
    """Join `big` with a lookup side on equal keys: inner, left, left_semi or left_anti.

    A side measured to be small is broadcast; any other goes through a shuffle join in
    which hot keys of `big` are sliced; where `big` has only the keys, its equal rows are counted
    and joined once. `small_fits` passes on an earlier measurement. A `derived` big side is computed
    and not read: the shuffle join stores it first, as it is measured and then joined. Without `sieve` no
    bitmap is made, which is right where nearly all rows have a partner.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how in ("left_semi", "left_anti"):
        small = small.select(*keys)
    if fits(small, max_rows) if small_fits is None else small_fits:
        return big.join(F.broadcast(small), keys, how)
    if not spread and set(big.columns) == set(keys):
        return _join_counted(big, small, keys, how, hot_rows)
    if derived:
        big = stored(big, "derived")
    bitmap = key_bitmap(small, big, keys) if sieve and how in ("inner", "left_semi", "left_anti") else None
    rest = None
    if bitmap is not None:  # what surely has no partner stays out of the exchange
        marked = with_hit(big, bitmap, keys)
        big, rest = marked.where("__hit").drop("__hit"), marked.where("NOT __hit").drop("__hit")
    big, (small,) = _spread(big, [small], keys, spread, hot_rows)
    joined = big.join(small, [*keys, _SALT], how).drop(_SALT)
    return joined.unionByName(rest) if how == "left_anti" and rest is not None else joined


def merge_on(frames: list[DataFrame], key: str, *, max_rows: int | None = None,
             hot_rows: int = HOT_ROWS, derived: bool = False) -> DataFrame:
    """Chain of inner joins on one key that share one partitioning on (key, slice), so each frame is shuffled once.

    Only the first frame is read for its hot keys; a `derived` one is computed and not read, so it is stored before.
    Spark broadcasts a side whose exchange turned out small. With `max_rows` the frames beyond the first are
    measured, and those that fit are broadcast at once.
    """
    first, *rest = frames
    small = [max_rows is not None and fits(f, max_rows) for f in rest]
    large = [f for f, s in zip(rest, small) if not s]
    joined = first
    if large:
        joined = stored(joined, "derived") if derived else joined
        joined, large = _spread(joined, large, [key], None, hot_rows)
        joined = reduce(lambda a, b: a.join(b, [key, _SALT], "inner"), large, joined).drop(_SALT)
    for frame in (f for f, s in zip(rest, small) if s):
        joined = joined.join(F.broadcast(frame), key, "inner")
    return joined


def first_match(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the lowest in `order`. Combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("best")
    )
    return best.select(*keys, "best.*")


def attach_labels(df: DataFrame, labels: DataFrame, key: str = "guid", label: str = "significance",
                  max_rows: int | None = None) -> DataFrame:
    """Left lookup of labels (key, label, pos); the last of repeated labels wins, none gives ''."""
    last = labels.groupBy(key).agg(F.max_by(label, "pos").alias(label))
    joined = lookup_join(df, last, key, "left", max_rows=max_rows)
    return joined.withColumn(label, F.coalesce(F.col(label).cast("string"), F.lit("")))


def mark_split(df: DataFrame, test_ids: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Add `split`: 'test' for rows whose key is in the id list, else 'train'. One pass over `df`."""
    ids = test_ids.select(F.col(test_ids.columns[0]).alias(key)).distinct()
    marked = lookup_join(df, ids.withColumn("is_test", F.lit(True)), key, "left", max_rows=max_rows)
    return marked.withColumn(
        "split", F.when(F.col("is_test"), "test").otherwise("train")
    ).drop("is_test")


def split_by_ids(df: DataFrame, test_ids: DataFrame, key: str,
                 max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) by membership in the id list."""
    ids = test_ids.select(F.col(test_ids.columns[0]).alias(key))
    train = lookup_join(df, ids, key, "left_anti", max_rows=max_rows)
    test = lookup_join(df, ids, key, "left_semi", max_rows=max_rows)
    return train, test


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=[f"`{c}`" for c in columns])


def join_features(df: DataFrame, features: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Put a block of features beside its rows by key; rows without features keep nulls."""
    return lookup_join(df, features, key, "left", max_rows=max_rows)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(n)
