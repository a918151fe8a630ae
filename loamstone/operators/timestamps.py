"""One UTC instant for timestamps written in mixed formats, precisions and zones.

Each value is matched once against a fixed list of shapes; the shape gives year, month, day, time, fraction and zone
as text, and with them the formats under which the value is valid. A source is a mixture of formats. It is fitted by
expectation-maximisation over compact counts (how many values of the source are valid under which set of formats): a
value counts for each of its formats in proportion to that format's weight, and the weights are the expected shares. The
declared order of a source enters as a finite number of prior values. The posterior of a value's formats chooses its
interpretation; where it is below `certainty`, the value is marked ambiguous and gets no instant. Of the shapes listed,
`a/b/yyyy` is the one that is valid under two formats.

Everything is a native expression. The data are scanned twice, once for the counts and once for the result; only a
table with one row per source is shuffled besides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstone.functions.domains import BLANKS
from loamstone.session import checkpointed

#: The table of sources is broadcast up to this many rows (a few MB) and joined by shuffle beyond.
BROADCAST_SOURCES = 50_000

#: Month names and their short forms in English, German, French, Spanish, Italian, Portuguese, Dutch.
MONTHS = {
    1: "january jan januar jänner janvier janv enero ene gennaio gen janeiro januari",
    2: "february feb februar février fevrier févr fevr febrero febbraio fevereiro fev februari",
    3: "march mar märz maerz mrz mars marzo março marco maart mrt",
    4: "april apr avril avr abril abr aprile",
    5: "may mai mayo maggio mag maio mei",
    6: "june jun juni juin junio giugno giu junho",
    7: "july jul juli juillet juil julio luglio lug julho",
    8: "august aug août aout agosto ago augustus",
    9: "september sept sep septembre septiembre settembre set setembro",
    10: "october oct oktober okt octobre octubre ottobre ott outubro out",
    11: "november nov novembre noviembre novembro",
    12: "december dec dezember dez décembre decembre déc diciembre dic dicembre dezembro",
}
#: Minutes east of UTC of the named zones.
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cet": 60, "bst": 60, "cest": 120, "ist": 330, "jst": 540,
    "aest": 600, "aedt": 660,
}

#: The formats of the mixture: year first, day first, month first, a named month after or before the day, bare Unix numbers.
FORMATS = ["ymd", "dmy", "mdy", "day_name", "name_day", "epoch"]
#: How many values a declared order counts for.
PRIOR = 1000.0

_ZONE = r"\s*([a-z]{1,5}|(?:utc|gmt)?[+-]\d{1,2}:?(?:\d{2})?)?"
_CLOCK = r"(?:,?\s*(?:t|at|um|à|a las|alle|,)?\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?\s*(am|pm|a\.\s?m\.|p\.\s?m\.)?" + _ZONE + ")?"
_NAME = r"([a-zà-öø-ÿ]{3,12})\.?"
#: Shapes, each with the groups to keep in the order: kind, first, second, third, hour, minute, second, fraction, half, zone.
_SHAPES = [
    (rf"^(\d{{4}})[-/_.](\d{{1,2}})[-/_.](\d{{1,2}}){_CLOCK}$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{1,2}})[-/_.](\d{{1,2}})[-/_.](\d{{4}}){_CLOCK}$", "num|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})?)?" + _ZONE + "$", "ymd|$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"^(?:[a-zà-öø-ÿ]{{2,12}}\.?,?\s+)?(\d{{1,2}})(?:\.|st|nd|rd|th|er|º)?\s+(?:de\s+)?{_NAME},?\s+(?:de\s+)?(\d{{4}}){_CLOCK}$", "dmy|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (rf"^(?:[a-zà-öø-ÿ]{{2,12}}\.?,\s+)?{_NAME}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_CLOCK}$", "mdy|$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
]
_EPOCH = r"^(\d{10}|\d{13}|\d{16})$"


def _shape(value: Column) -> Column:
    """Text fields of the value, split at `|`; one field only where no shape fits."""
    v = F.lower(F.trim(value, F.lit(BLANKS)))
    out = v
    for pattern, to in _SHAPES:
        out = F.regexp_replace(out, pattern, to)
    return F.when(v.rlike(_EPOCH), F.concat(F.lit("epoch|"), v)).when(F.instr(v, "|") == 0, out)


def _month(name: Column) -> Column:
    pairs = [F.lit(x) for n, names in MONTHS.items() for word in names.split() for x in (word, n)]
    return F.try_element_at(F.create_map(*pairs), name)


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01; null where the day does not exist."""
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return F.datediff(F.try_to_date(text, "yyyy-MM-dd"), F.lit("1970-01-01").cast("date"))


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each computed once per row: a generator of one row keeps the optimiser from copying their
    expressions into every place that uses them."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def parsed(df: DataFrame, value: str) -> DataFrame:
    """df with the columns _kind, _dmy and _mdy (days under either order), _clock (microseconds into the day) and
    _offset (minutes east of UTC, null without a zone), _micros (of an epoch number), _fit (all parts are valid)."""
    df = _held(df, _s=F.split(_shape(F.col(f"`{value}`")), r"\|"))
    at = lambda i: F.get(F.col("_s"), F.lit(i))
    num = lambda i: F.when(at(i).rlike(r"^\d{1,4}$"), at(i).cast("int"))
    df = _held(
        df, _kind=F.when(at(0).isin("ymd", "num", "dmy", "mdy", "epoch"), at(0)),
        **{f"_n{i}": num(i) for i in range(1, 7)}, _w1=at(1), _w2=at(2),
        _micro=F.coalesce(F.rpad(F.substring(at(7), 1, 6), 6, "0").cast("int"), F.lit(0)), _half=F.substring(at(8), 1, 1), _zone=F.coalesce(at(9), F.lit("")),
        _bare=F.coalesce(at(4), F.lit("")) == "",
    ).drop("_s")
    kind, n1, n2, n3, hour, minute = (F.col(c) for c in ("_kind", "_n1", "_n2", "_n3", "_n4", "_n5"))
    second = F.coalesce("_n6", F.lit(0))
    year = F.when(kind == "ymd", n1).otherwise(n3)
    month = F.when(kind.isin("ymd", "num"), n2).otherwise(_month(F.when(kind == "dmy", F.col("_w2")).otherwise(F.col("_w1"))))
    day = F.when(kind == "ymd", n3).when(kind == "mdy", n2).otherwise(n1)
    half = F.col("_half")
    hour = F.when(half == "", hour).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    zone = F.col("_zone")
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    hours = F.when(F.length(digits) > 2, F.left(digits, F.length(digits) - 2)).otherwise(digits).cast("int")
    minutes = F.when(F.length(digits) > 2, F.right(digits, F.lit(2)).cast("int")).otherwise(0)
    table = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    offset = F.when(zone.rlike(r"[+-]"), (hours * 60 + minutes) * F.when(F.instr(zone, "-") > 0, -1).otherwise(1))
    df = _held(df, _year=year, _month=month, _day=day, _hour=hour, _offset=offset.otherwise(F.try_element_at(table, zone)))
    hour = F.col("_hour")
    clock = F.when(F.col("_bare"), F.lit(0).cast("long")).when(
        (hour <= 23) & (minute <= 59) & (second <= 59),
        ((hour * 60 + minute) * 60 + second).cast("long") * 1_000_000 + F.col("_micro"),
    )
    size = F.length("_w1")
    unit = F.when(size == 10, 1_000_000).when(size == 13, 1_000).otherwise(1)
    df = _held(
        df, _dmy=_days(F.col("_year"), F.col("_month"), F.col("_day")), _mdy=F.when(kind == "num", _days(F.col("_year"), F.col("_day"), F.col("_month"))),
        _clock=clock, _micros=F.when(kind == "epoch", F.col("_w1").cast("long") * unit),
    )
    fit = (kind == "epoch") | (F.col("_clock").isNotNull() & ((zone == "") | F.col("_offset").isNotNull()))
    return df.withColumn("_fit", F.coalesce(fit, F.lit(False)))


def valid_formats(values: DataFrame) -> Column:
    """The formats under which a value of parsed() is valid, as bits in the order of FORMATS."""
    kind, d, m = F.col("_kind"), F.col("_dmy").isNotNull(), F.col("_mdy").isNotNull()
    bit = lambda name, c: F.when(c & F.col("_fit"), 1 << FORMATS.index(name)).otherwise(0)
    return (
        bit("ymd", (kind == "ymd") & d) + bit("dmy", (kind == "num") & d) + bit("mdy", (kind == "num") & m) + bit("day_name", (kind == "dmy") & d)
        + bit("name_day", (kind == "mdy") & d) + bit("epoch", kind == "epoch")
    )


def order_mixture(values: DataFrame, source: str, declared: str, prior_weight: float = PRIOR, rounds: int = 25) -> DataFrame:
    """Per source, the fitted mixture of formats: (source, n_dmy_only, n_mdy_only, n_both, weights, p_dmy).

    values is the output of parsed(). `declared` names a column with `dmy`, `mdy` or null; a declared order counts as
    prior_weight values seen in that order, every format as one. Expectation: a value belongs to each format it is valid
    under with a probability in proportion to the format's weight. Maximisation: the weights are the expected shares. With
    counts only, each round is arithmetic on one row per source. p_dmy is the probability of day first against month first.
    """
    held = values.withColumn("_mask", F.coalesce(valid_formats(values), F.lit(0))).where("_mask > 0")
    flag = lambda order: F.max(F.when(F.col(declared) == order, 1).otherwise(0))
    counts = held.groupBy(source, "_mask").agg(F.count("*").alias("_n"), flag("dmy").alias("_d"), flag("mdy").alias("_m"))
    d, m = 1 << FORMATS.index("dmy"), 1 << FORMATS.index("mdy")
    of = lambda mask: F.sum(F.when(F.col("_mask") == mask, F.col("_n")).otherwise(0))
    table = counts.groupBy(source).agg(
        of(d).alias("n_dmy_only"), of(m).alias("n_mdy_only"), of(d | m).alias("n_both"), F.collect_list(F.struct("_mask", "_n")).alias("_c"),
        F.max("_d").alias("_d"), F.max("_m").alias("_m"), F.sum("_n").alias("_all"),
    )
    prior = [1.0 + (F.col({"dmy": "_d", "mdy": "_m"}[k]) * float(prior_weight) if k in ("dmy", "mdy") else F.lit(0.0)) for k in FORMATS]
    total = sum(prior[1:], prior[0]) + F.col("_all")

    def step(w: Column) -> Column:
        """One round for all formats: each count is shared out over its formats in proportion to their weights."""
        holds = lambda mask, k: mask.bitwiseAND(F.lit(1 << k)) > 0
        within = lambda mask: sum([F.when(holds(mask, k), w[k]).otherwise(0.0) for k in range(1, len(FORMATS))], F.when(holds(mask, 0), w[0]).otherwise(0.0))
        part = lambda k: lambda s, c: s + F.when(holds(c["_mask"], k), c["_n"] * w[k] / within(c["_mask"])).otherwise(0.0)
        return F.array(*[(prior[k] + F.aggregate("_c", F.lit(0.0), part(k))) / total for k in range(len(FORMATS))])

    start = F.array(*[x / sum(prior[1:], prior[0]) for x in prior])
    fitted = table.withColumn("weights", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda w, _: step(w)))
    i, j = FORMATS.index("dmy"), FORMATS.index("mdy")
    return fitted.withColumn("p_dmy", F.col("weights")[i] / (F.col("weights")[i] + F.col("weights")[j])).drop("_c", "_d", "_m", "_all")


def normalised(
    df: DataFrame, value: str, source: str, zone: str, declared: str, *, prior_weight: float = PRIOR, certainty: float = 0.8
) -> DataFrame:
    """df with utc_us (microseconds since 1970-01-01 UTC, or null), ts_status and ts_posterior.

    `source`, `zone` (IANA name) and `declared` (`dmy`, `mdy` or null) name columns of df. ts_status is `ok`,
    `ambiguous` (both orders are possible and neither reaches `certainty`), `invalid` (a known shape that names no
    existing day or time, also where only the order less likely than 1 - certainty would give one) or `unparsed` (null,
    blank or of no known shape). A local time that occurs twice is the earlier instant; a skipped one moves forward by
    the gap. A null or unknown zone counts as UTC. Other columns, repeated rows and their order are left alone; columns
    named utc_us, ts_status or ts_posterior are replaced. An empty table gives an empty one.
    """
    keep = [c for c in df.columns if c not in ("utc_us", "ts_status", "ts_posterior")]
    work = parsed(df.select(*[F.col(f"`{c}`") for c in keep]), value)
    mixture = checkpointed(order_mixture(work, source, declared, prior_weight).select(F.col(source).alias("_source"), "p_dmy"))
    if mixture.count() <= BROADCAST_SOURCES:
        mixture = F.broadcast(mixture)
    work = work.join(mixture, F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
    p = F.coalesce(F.col("p_dmy"), F.lit(0.5))
    d, m, fits = F.col("_dmy"), F.col("_mdy"), F.col("_fit")
    both = d.isNotNull() & m.isNotNull() & (d != m)
    wide = F.greatest(p, 1 - p)
    posterior = (
        F.when(F.col("_kind").isNull() | ~fits, None)
        .when(F.col("_kind") != "num", F.lit(1.0))
        .when(both, wide)
        .when(d.isNotNull() & m.isNotNull(), F.lit(1.0))
        .when(d.isNotNull(), p)
        .when(m.isNotNull(), 1 - p)
    )
    day = F.when(F.col("_kind") != "num", d).when(both, F.when(p >= 0.5, d).otherwise(m)).otherwise(F.coalesce(d, m))
    # a value that fits only one order counts unless the source is known to write the other one
    sure = F.when(both, posterior >= certainty).otherwise(posterior > 1 - certainty)
    local = day.cast("long") * 86_400_000_000 + F.col("_clock")
    known = F.when(F.coalesce(F.col(zone), F.lit("")) == "", F.lit("UTC")).otherwise(F.col(zone))
    placed = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), known))
    utc = F.coalesce(F.col("_micros"), F.when(F.col("_offset").isNotNull(), local - F.col("_offset").cast("long") * 60_000_000).otherwise(placed))
    ok = fits & sure & (day.isNotNull() | F.col("_micros").isNotNull())
    ok = F.coalesce(ok, F.lit(False)) | (F.col("_kind") == "epoch")
    status = (
        F.when(F.col("_kind").isNull(), "unparsed")
        .when(ok, "ok")
        .when(fits & both, "ambiguous")
        .otherwise("invalid")
    )
    return (
        work.withColumn("utc_us", F.when(ok, utc)).withColumn("ts_status", status).withColumn("ts_posterior", posterior)
        .select(*[F.col(f"`{c}`") for c in keep], "utc_us", "ts_status", "ts_posterior")
    )
