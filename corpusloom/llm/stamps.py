"""Times as text in mixed forms to UTC: anchored branches, votes for the order of day and month, offsets probed either side.

Each form has one anchored pattern, and its parts become a wall time by ``try_make_timestamp``, which gives null for what no
calendar or clock has. ``a/b/y`` is tried in both orders; stamps possible in one order only vote for it in their source.
A wall time without offset is looked up in its zone twice, a day before and a day after, by ``from_utc_timestamp``: where the
two offsets differ, a round trip through each tells a plain time from one that the zone skips (neither returns) or repeats
(both return); these take the offset after the change.

Nulls, empty and other text, and impossible stamps are bad. So are stamps without offset whose zone is null or not known to
the JVM, as their instant can't be known; bad stamps never vote. Rows without source are one source. Repeated rows are rows
of their own; other columns don't matter, and tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_KEYS, LEAST_HOT, source_key, stored

#: The white space of the contract, the months, and the parts of the patterns.
BLANKS = " \t\n\x0b\x0c\r"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
YEAR, TWO, MONTH = "(20[0-9][0-9])", "([0-9][0-9])", "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
CLOCK = r"(?:[T\x20]([0-9][0-9]):([0-5][0-9])(?::([0-5][0-9]))?(?:\x20?([AP])M)?(?:\x20?(Z|[+-](?:0[0-9]|1[0-4]):?[0-5][0-9]))?)?\z"
EPOCH = r"^([0-9]{10}|[0-9]{13})\z"
#: For each form its pattern, the groups of year, month and day, and whether month and day can change places.
FORMS = (
    (f"^{YEAR}-{TWO}-{TWO}{CLOCK}", (1, 2, 3), False),
    (f"^{YEAR}{TWO}{TWO}{CLOCK}", (1, 2, 3), False),
    (f"^{TWO}[.]{TWO}[.]{YEAR}{CLOCK}", (3, 2, 1), False),
    (rf"^{TWO}\x20{MONTH}\x20{YEAR}{CLOCK}", (3, 2, 1), False),
    (f"^{TWO}/{TWO}/{YEAR}{CLOCK}", (3, 2, 1), True),
)
DAY_US = 86_400_000_000
#: What the decisions may be to be broadcast whole: so many sources, and so many bytes of names. Beyond, only those of hot sources are.
SOURCES, NAME_BYTES = 65_536, 4_000_000


def _number(text: Column, empty: int = 0) -> Column:
    """Digits as an int; ``empty`` for an empty string, null for anything else."""
    return F.when(text == "", F.lit(empty)).otherwise(text.try_cast("int"))


def _parts(stamp: Column) -> Column:
    """The parts of a stamp by the one form that it wholly has, else null."""
    found = F.lit(None)
    for pattern, places, slashed in reversed(FORMS):
        part = lambda i, p=pattern: F.regexp_extract(stamp, p, i)
        names = zip(("year", "month", "day", "hour", "minute", "second", "half", "offset"), (*places, 4, 5, 6, 7, 8), strict=True)
        one = F.struct(*(part(i).alias(n) for n, i in names), F.lit(slashed).alias("slashed"))
        found = F.when(part(0) != "", one).otherwise(found)
    return found


def _hour(p: Column) -> Column:
    """The hour from 0; with AM or PM it must be 1 to 12."""
    hour = _number(p["hour"])
    return F.when(p["half"] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(p["half"] == "P", 12).otherwise(0))


def _offset_us(offset: Column) -> Column:
    """An explicit offset in microseconds, 0 for Z."""
    digits = F.replace(offset, F.lit(":"), F.lit(""))
    minutes = F.substring(digits, 2, 2).try_cast("long") * 60 + F.substring(digits, 4, 2).try_cast("long")
    return F.when(offset == "Z", F.lit(0).cast("long")).otherwise(minutes * F.when(F.substring(offset, 1, 1) == "-", -60_000_000).otherwise(60_000_000))


def known_zones(spark: SparkSession) -> list[str]:
    return sorted(str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds())


def read(stamps: DataFrame, raw: str = "raw", zone: str = "zone") -> DataFrame:
    """Adds what a row's own text says: ``__epoch`` (microseconds), ``__offset`` (microseconds, null without one), ``__zone``
    (null if unknown), and ``__dm`` and ``__md``, the wall time by each order. A form with one order has it as ``__dm``."""
    rows = stamps.withColumn("__stamp", F.btrim(F.col(raw), F.lit(BLANKS)))
    rows = rows.withColumns({"__digits": F.regexp_extract("__stamp", EPOCH, 1), "__p": _parts(F.col("__stamp")), "__zone": F.when(F.col(zone).isin(known_zones(stamps.sparkSession)), F.col(zone))})
    p, n = F.col("__p"), F.col("__digits").try_cast("long")
    month = F.when(F.length(p["month"]) == 3, F.floor((F.position(p["month"], F.lit(MONTHS)) + 2) / 3).cast("int")).otherwise(_number(p["month"]))
    rows = rows.withColumns({
        "__epoch": F.when(F.length("__digits") == 10, n * 1_000_000).when(F.length("__digits") == 13, n * 1_000),
        "__t": F.struct(_number(p["year"]).alias("y"), month.alias("m"), _number(p["day"]).alias("d"), _hour(p).alias("h"), _number(p["minute"]).alias("i"), _number(p["second"]).alias("s")),
        "__slashed": p["slashed"],
        "__offset": F.when(p["offset"] != "", _offset_us(p["offset"])),
    })
    placed = F.col("__offset").isNotNull() | F.col("__zone").isNotNull()
    t = F.col("__t")
    wall = lambda m, d: F.unix_micros(F.try_make_timestamp(t["y"], m, d, t["h"], t["i"], t["s"], F.lit("UTC")).cast("timestamp"))
    rows = rows.withColumns({"__dm": F.when(placed, wall(t["m"], t["d"])), "__md": F.when(placed & F.col("__slashed"), wall(t["d"], t["m"]))})
    return rows.drop("__stamp", "__digits", "__p", "__t", "__slashed")


def _open() -> Column:
    """Rows whose two orders are both possible and give different dates."""
    return F.coalesce(F.col("__dm") != F.col("__md"), F.lit(False))


def votes(stamps: DataFrame, raw: str = "raw", zone: str = "zone", source: str = "source", margin: int = 10) -> DataFrame:
    """(__source, order, n): for each source with stamps open in their order the order it has voted for, ``dm`` or ``md``, or
    ``-`` where none has over ``margin`` times the other's votes; and how many stamps wait for it. Counts are summed map-side."""
    slashed = stamps.select(source_key(F.col(source)).alias("__source"), F.col(raw).alias("raw"), F.col(zone).alias("zone")).where(F.contains("raw", F.lit("/")))
    dm, md = F.col("__dm"), F.col("__md")
    # a slashed form with one order only has __md where that order is month first
    counted = read(slashed).groupBy("__source").agg(F.count_if(dm.isNotNull() & md.isNull()).alias("dm"), F.count_if(dm.isNull() & md.isNotNull()).alias("md"), F.count_if(_open()).alias("n"))
    order = F.when(F.col("dm") > margin * F.col("md"), "dm").when(F.col("md") > margin * F.col("dm"), "md").otherwise("-")
    return counted.where("n > 0").select("__source", order.alias("order"), "n")


def with_order(rows: DataFrame, decided: DataFrame, source: str = "source", most_sources: int = SOURCES) -> DataFrame:
    """Adds ``__order``, what a row's source has voted for, to rows that wait for it; ``decided`` is a written table of :func:`votes`.

    The decisions are broadcast if they are few (their count and bytes are looked up first). Else those of sources with more
    than one in HOT_KEYS of the waiting rows are, fewer than HOT_KEYS whatever the input; rows of the others are shuffled, and
    rows that wait for nothing are spread evenly.
    """
    key = source_key(F.col(source))
    won = decided.where("order != '-'")
    n, name_bytes = won.agg(F.count(F.lit(1)), F.sum(F.octet_length("__source"))).first()
    if n <= most_sources and (name_bytes or 0) <= NAME_BYTES:
        small = F.broadcast(won.select("__source", F.col("order").alias("__order")))
        return rows.withColumn("__key", F.when(_open(), key)).join(small, F.col("__key") == F.col("__source"), "left").drop("__key", "__source")
    waiting = decided.agg(F.sum("n")).first()[0]
    least = max(LEAST_HOT, waiting // HOT_KEYS)
    hot = decided.where(F.col("n") > least).select(F.col("__source").alias("__hot"), F.col("order").alias("__first"))
    cold = decided.where(F.col("n") <= least).select("__source", F.col("order").alias("__second"))
    rows = rows.withColumn("__key", F.when(_open(), key)).join(F.broadcast(hot), F.col("__key") == F.col("__hot"), "left")
    alone = F.concat(F.lit("-"), F.xxhash64("__dm", "__epoch", "__offset", F.monotonically_increasing_id()).cast("string"))
    rows = rows.withColumn("__key", F.when(F.col("__key").isNotNull() & F.col("__first").isNull(), F.col("__key")).otherwise(alone))
    rows = rows.join(cold, F.col("__key") == F.col("__source"), "left").withColumn("__order", F.coalesce("__first", "__second"))
    return rows.drop("__key", "__hot", "__first", "__source", "__second")


def _shift(us: Column, zone: Column) -> Column:
    """Microseconds of an instant as the wall clock of a zone shows it."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), zone))


def normalise(stamps: DataFrame, raw: str = "raw", zone: str = "zone", source: str = "source", margin: int = 10, most_sources: int = SOURCES) -> DataFrame:
    """``stamps`` with ``utc_us`` (null if bad), ``rule`` (bad, epoch, votes, default or plain) and ``ambiguous``."""
    names = [c for c in stamps.columns if c not in ("utc_us", "rule", "ambiguous")]
    decided = stored(votes(stamps, raw, zone, source, margin), "votes")
    plain = stamps.select(*(F.col(f"`{n}`").alias(f"__{i}") for i, n in enumerate(names)), F.col(raw).alias("__raw"), F.col(zone).alias("__in"), F.col(source).alias("__from"))
    rows = with_order(read(plain, "__raw", "__in"), decided, "__from", most_sources)
    by_md = F.coalesce(F.col("__order") == "md", F.lit(False))
    wall = F.when(by_md & _open(), F.col("__md")).otherwise(F.coalesce("__dm", "__md"))
    rows = rows.withColumns({"__wall": wall, "__open": _open()})
    at = F.col("__wall")
    rows = rows.withColumn("__probe", F.when(F.col("__offset").isNull() & at.isNotNull(), F.struct((_shift(at - DAY_US, F.col("__zone")) - at + DAY_US).alias("early"), (_shift(at + DAY_US, F.col("__zone")) - at - DAY_US).alias("late"))))
    early, late = F.col("__probe.early"), F.col("__probe.late")
    back = lambda offset: _shift(at - offset, F.col("__zone")) == at
    # a change within a day either side: 'early' and 'late' say whether each of the two offsets returns to the wall time
    rows = rows.withColumn("__round", F.when(early != late, F.struct(back(early).alias("early"), back(late).alias("late"))))
    only_early = F.coalesce(F.col("__round.early") & ~F.col("__round.late"), F.lit(False))
    odd = F.coalesce(F.col("__round.early") == F.col("__round.late"), F.lit(False))
    utc = F.coalesce("__epoch", at - F.coalesce(F.col("__offset"), F.when(only_early, early).otherwise(late)))
    rule = F.when(F.col("__epoch").isNotNull(), "epoch").when(at.isNull(), "bad").when(F.col("__open") & F.col("__order").isin("dm", "md"), "votes").when(F.col("__open"), "default").otherwise("plain")
    return rows.select(*(F.col(f"__{i}").alias(n) for i, n in enumerate(names)), utc.alias("utc_us"), rule.alias("rule"), (F.col("__open") | odd).alias("ambiguous"))
