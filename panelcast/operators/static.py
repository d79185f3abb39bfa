"""Leakage-safe static scale features (shares of volume up to a cutoff)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAMILY, ENTITY, MONTH = "Family", "FIPS", "date"
RECENT_MONTHS = 36
SPARSE_BELOW = 6


def _share(part: str, total: str):
    # zero or missing total -> 0 (never an ANSI division error)
    return F.coalesce(F.when(F.col(total) > 0, F.try_divide(F.col(part), F.col(total))),
                      F.lit(0.0))


def static_shares(panel: DataFrame, cutoff, *, sales: str = "Sales_QTY",
                  state: str = "State") -> DataFrame:
    """One row per (Family, FIPS): all-time / recent / state share, active months, sparse flag.

    Only rows with ``date <= cutoff`` count; "recent" is the last 36 months
    up to the cutoff, both ends inclusive. The family and (family, state)
    totals are small aggregates (families, families x states) and are
    broadcast; the per-entity aggregate is keyed like the panel partitioning.
    """
    cut = F.lit(cutoff).cast("date")
    hist = panel.filter(F.col(MONTH) <= cut)
    recent = F.col(MONTH) >= F.add_months(cut, -RECENT_MONTHS)
    members = panel.select(FAMILY, ENTITY, state).distinct()
    # keyed by (Family, FIPS) like the panel partitioning: no extra shuffle.
    # An entity listed under two states keeps one total over both.
    ent = (hist.groupBy(FAMILY, ENTITY)
           .agg(F.sum(sales).alias("_etot"),
                F.sum(F.when(recent, F.col(sales))).alias("_erec"),
                F.count_if(F.col(sales) > 0).alias("_eactive")))
    fam = hist.groupBy(FAMILY).agg(F.sum(sales).alias("_ftot"),
                                  F.sum(F.when(recent, F.col(sales))).alias("_frec"))
    st = hist.groupBy(FAMILY, state).agg(F.sum(sales).alias("_stot"))
    out = (members.join(ent, [FAMILY, ENTITY], "left")
           .join(F.broadcast(fam), FAMILY, "left")
           .join(F.broadcast(st), [FAMILY, state], "left"))
    active = F.coalesce(F.col("_eactive"), F.lit(0))
    return out.select(
        FAMILY, ENTITY, state,
        _share("_etot", "_ftot").alias("county_alltime_share"),
        _share("_erec", "_frec").alias("county_recent_share"),
        _share("_stot", "_ftot").alias("state_share"),
        active.cast("double").alias("county_active_months"),
        (active < SPARSE_BELOW).cast("int").alias("county_is_sparse"))


def shares_by_month(panel: DataFrame, *, sales: str = "Sales_QTY", state: str = "State", as_of: str = "as_of") -> DataFrame:
    """:func:`static_shares` as of every month of the dense panel: one row per (Family, FIPS, State, ``as_of``).

    Running sums of entities, states and families over the months, joined by month: one pass serves any number of
    cut-offs, and no month knows a later one. The sums of states and families are small (states x months) and broadcast; those of
    entities stay in the panel's entity partitioning.
    """
    def running(keys: list[str], prefix: str) -> DataFrame:
        upto = Window.partitionBy(*keys).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
        recent = Window.partitionBy(*keys).orderBy(MONTH).rowsBetween(-RECENT_MONTHS, 0)
        months = panel.groupBy(*keys, MONTH).agg(F.sum(sales).alias("_s"), F.count_if(F.col(sales) > 0).alias("_a"))
        return months.select(*keys, MONTH, F.sum("_s").over(upto).alias(f"_{prefix}tot"), F.sum("_s").over(recent).alias(f"_{prefix}rec"),
                             F.sum("_a").over(upto).alias(f"_{prefix}active"))

    members = panel.select(FAMILY, ENTITY, state).distinct()
    out = (members.join(running([FAMILY, ENTITY], "e"), [FAMILY, ENTITY])
           .join(F.broadcast(running([FAMILY], "f").drop("_factive")), [FAMILY, MONTH], "left")
           .join(F.broadcast(running([FAMILY, state], "s").select(FAMILY, state, MONTH, "_stot")), [FAMILY, state, MONTH], "left"))
    return out.select(
        FAMILY, ENTITY, state, F.col(MONTH).alias(as_of),
        _share("_etot", "_ftot").alias("county_alltime_share"),
        _share("_erec", "_frec").alias("county_recent_share"),
        _share("_stot", "_ftot").alias("state_share"),
        F.col("_eactive").cast("double").alias("county_active_months"),
        (F.col("_eactive") < SPARSE_BELOW).cast("int").alias("county_is_sparse"))


def add_static_shares(panel: DataFrame, cutoff, *, state: str = "State", monthly: DataFrame | None = None) -> DataFrame:
    """Attach :func:`static_shares` of ``monthly`` (else of the panel) to every panel row; absent entity -> 0 / sparse."""
    sh = static_shares(panel if monthly is None else monthly, cutoff, state=state)
    return with_shares(panel, sh, [FAMILY, ENTITY, state])


def with_shares(df: DataFrame, shares: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the share columns of ``shares`` (instead of its own, if any); an absent entity has 0 and is sparse."""
    absent = {"county_alltime_share": F.lit(0.0), "county_recent_share": F.lit(0.0), "state_share": F.lit(0.0),
              "county_active_months": F.lit(0.0), "county_is_sparse": F.lit(1)}
    joined = df.drop(*absent).join(shares.select(*keys, *absent).hint("shuffle_hash"), keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in absent.items()})
