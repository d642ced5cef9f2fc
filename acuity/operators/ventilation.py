"""Ventilation episodes from on/off care-plan records.

Records are first settled to at most one on-row and one off-row per minute of a stay,
with a map-side step before the shuffle. All later steps are windows over the stay's
settled rows, so they share one layout by stay and are bounded by its length in time.
Within one minute the on-row comes before the off-row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from acuity import rules
from acuity.functions import like_any, one_of

EVENT = (
    "cplgeneralid",
    "patientunitstayid",
    "activeupondischarge",
    "cplitemoffset",
    "cplgroup",
    "cplitemvalue",
    "vent_flag",
)
STAY = "patientunitstayid"


def _stay() -> WindowSpec:
    return Window.partitionBy(STAY)


def _in_time() -> WindowSpec:
    return _stay().orderBy("cplitemoffset", F.desc("vent_flag"), "cplgeneralid")


def _on() -> Column:
    return F.col("vent_flag") == 1


def _active() -> Column:
    return F.col("activeupondischarge")


def _event(**changed: Column) -> Column:
    """The row's record without its stay, as a struct with some fields replaced."""
    return F.struct(*[changed.get(c, F.col(c)).alias(c) for c in EVENT if c != STAY])


def _closing(**changed: Column) -> Column:
    return _event(
        cplitemvalue=F.lit(rules.VENT_CLOSING_VALUE), vent_flag=F.lit(0), **changed
    )


def _events(df: DataFrame, records: Column) -> DataFrame:
    """A row per record of the array.

    The stay stays outside the records, so that Spark still knows how rows are laid out.
    """
    return df.select(STAY, F.inline(records)).select(*EVENT)


def classify_vent_events(careplan: DataFrame) -> DataFrame:
    """Airway and ventilation records with their on/off flag; those without a time stay."""
    value = F.col("cplitemvalue")
    on = like_any("cplitemvalue", rules.VENT_ON_LIKE) | one_of("cplitemvalue", rules.VENT_ON)
    return careplan.where(
        one_of("cplgroup", rules.VENT_GROUPS) & (value != "")
    ).select(*EVENT[:-1], F.when(on, 1).otherwise(0).alias("vent_flag"))


def resolve_same_instant(events: DataFrame) -> DataFrame:
    """At most one on-row and one off-row per minute of a stay.

    The on-row with the smallest text stays. An on-row takes one off-row away, the one
    with the smallest text; of the off-rows left the one with the largest text stays.
    Equal texts go by row id. Records without a time are one minute of their own, before
    all others, in which an on-row takes no off-row away.
    """
    fields = ("cplitemvalue", "cplgeneralid", "activeupondischarge", "cplgroup")
    record = F.struct(*fields)
    settled = events.groupBy(STAY, "cplitemoffset").agg(
        F.min(F.when(_on(), record)).alias("on_row"),
        F.min(F.when(~_on(), record)).alias("taken_away"),
        F.max(F.when(~_on(), record)).alias("off_row"),
    )

    def kept(source: str, flag: int) -> Column:
        return _event(vent_flag=F.lit(flag), **{c: F.col(source)[c] for c in fields})

    on_row = F.when(F.col("on_row").isNotNull(), kept("on_row", 1))
    # with copies of one off-row only, taking it away leaves none
    other_row = F.col("off_row.cplgeneralid") != F.col("taken_away.cplgeneralid")
    stays_on = F.col("on_row").isNull() | F.col("cplitemoffset").isNull() | other_row
    off_row = F.when(F.col("off_row").isNotNull() & stays_on, kept("off_row", 0))
    return _events(settled, F.array(on_row, off_row)).where(F.col("vent_flag").isNotNull())


def trim_leading_off(events: DataFrame) -> DataFrame:
    """Drop what lies before the first on-row of a stay, and stays without one.

    An on-row without a time comes first, so that nothing of its stay is dropped.
    """
    untimed_on = F.max(_on() & F.col("cplitemoffset").isNull()).over(_stay())
    first_on = F.min(F.when(_on(), F.col("cplitemoffset"))).over(_stay())
    return (
        events.withColumns({"untimed_on": untimed_on, "first_on": first_on})
        .where(F.col("untimed_on") | (F.col("cplitemoffset") >= F.col("first_on")))
        .select(*EVENT)
    )


def _is_last() -> Column:
    return F.lead("vent_flag").over(_in_time()).isNull()


def close_open_tail(events: DataFrame, minutes: int = rules.VENT_OPEN_TAIL_MINUTES) -> DataFrame:
    """A stay that ends on, not active at discharge: add an off-row some minutes later."""
    open_tail = F.col("is_last") & _on() & _active().eqNullSafe(False)
    later = _closing(cplitemoffset=F.col("cplitemoffset") + minutes)
    return _events(
        events.withColumn("is_last", _is_last()),
        F.when(open_tail, F.array(_event(), later)).otherwise(F.array(_event())),
    )


def settle_last_pair(events: DataFrame) -> DataFrame:
    """A last off-row right after an active on-row becomes a plain inactive one."""
    before = F.lag(F.struct("vent_flag", "activeupondischarge")).over(_in_time())
    rewritten = (
        F.col("is_last")
        & ~_on()
        & (F.col("before")["vent_flag"] == 1)
        & F.col("before")["activeupondischarge"].eqNullSafe(True)
    )
    return (
        events.withColumns({"is_last": _is_last(), "before": before})
        .withColumn("rewritten", F.coalesce(rewritten, F.lit(False)))
        .withColumns(
            {
                "activeupondischarge": F.when(F.col("rewritten"), False).otherwise(_active()),
                "cplitemvalue": F.when(F.col("rewritten"), rules.VENT_CLOSING_VALUE).otherwise(
                    F.col("cplitemvalue")
                ),
            }
        )
        .select(*EVENT)
    )


def close_at_discharge(events: DataFrame, stays: DataFrame) -> DataFrame:
    """A stay that ends on and active: add an off-row at unit discharge.

    Copies of a stay's record are merged before the join; the last discharge counts.
    """
    discharge = stays.groupBy(STAY).agg(F.max("unitdischargeoffset").alias("unitdischargeoffset"))
    open_tail = F.col("is_last") & _on() & _active().eqNullSafe(True)
    at_discharge = _closing(
        activeupondischarge=F.lit(False),
        cplitemoffset=F.col("unitdischargeoffset"),
        cplgroup=F.lit(rules.VENT_CLOSING_GROUP),
    )
    return _events(
        events.withColumn("is_last", _is_last()).join(discharge, STAY, "left"),
        F.when(open_tail, F.array(_event(), at_discharge)).otherwise(F.array(_event())),
    )


def vent_events(careplan: DataFrame, stays: DataFrame) -> DataFrame:
    """Settled, trimmed and closed on/off rows of every ventilated stay."""
    events = trim_leading_off(resolve_same_instant(classify_vent_events(careplan)))
    return close_at_discharge(settle_last_pair(close_open_tail(events)), stays)


def episodes(events: DataFrame, mode: str = "reference") -> DataFrame:
    """Ventilation intervals (stay, starttime, endtime), both ends included.

    ``reference``  the moments of every on-row and of the row after it, each once, in
    time order and paired two by two. A moment without a partner is left out. Runs of
    several on-rows are so cut into pairs and can shift the pairs after them.
    ``islands``  one interval per run of on-rows, up to the off-row that ends it.
    """
    if mode == "islands":
        return _islands(events)
    if mode != "reference":
        raise ValueError(f"unknown episode mode: {mode}")
    moment = "moment"
    moments = (
        events.select(
            STAY,
            "vent_flag",
            "cplitemoffset",
            F.lead("vent_flag").over(_in_time()).alias("next_flag"),
            F.lead("cplitemoffset").over(_in_time()).alias("next_offset"),
        )
        .where(_on() & F.col("next_flag").isNotNull())
        .select(STAY, F.explode(F.array("cplitemoffset", "next_offset")).alias(moment))
        .where(F.col(moment).isNotNull())
        .distinct()
    )
    ordered = _stay().orderBy(moment)
    return (
        moments.select(
            STAY,
            F.col(moment).alias("starttime"),
            F.lead(moment).over(ordered).alias("endtime"),
            F.row_number().over(ordered).alias("position"),
        )
        .where((F.col("position") % 2 == 1) & F.col("endtime").isNotNull())
        .select(STAY, "starttime", "endtime")
    )


def _islands(events: DataFrame) -> DataFrame:
    """The runs are numbered by the off-rows seen so far; the next off-row ends a run."""
    so_far = _in_time().rowsBetween(Window.unboundedPreceding, -1)
    return (
        events.where(F.col("cplitemoffset").isNotNull())
        .withColumn("run", F.coalesce(F.count(F.when(~_on(), 1)).over(so_far), F.lit(0)))
        .groupBy(STAY, "run")
        .agg(
            F.min(F.when(_on(), F.col("cplitemoffset"))).alias("starttime"),
            F.min(F.when(~_on(), F.col("cplitemoffset"))).alias("endtime"),
        )
        .where(F.col("starttime").isNotNull() & F.col("endtime").isNotNull())
        .select(STAY, "starttime", "endtime")
    )
