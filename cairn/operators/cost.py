"""What the observed span of a project costs at published rates; a rate card, scenarios, and what each rate moves.

Every figure is a range, from the low and high values of anchors(anchor_id, value_low, value_high, confidence, reverify_by).
An anchor named <base>_<technology> goes before a shared <base>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.rules import PRICED, withheld

# What each technology needs, and the units of time.
ENERGY = ("solar", "wind")
TECH_BASES = ("capex_per_mw", "construction_escalation", "fixed_om_kw_year", "project_life_years")
ENERGY_BASES = ("capacity_factor", "ppa_price_mwh")
STORAGE_BASES = ("capacity_price_kw_month",)
SHARED_BASES = ("carrying_rate", "predevelopment_share")
BASES = (*TECH_BASES, *ENERGY_BASES, *STORAGE_BASES, *SHARED_BASES)
DAYS_PER_MONTH, HOURS_PER_YEAR = 30.44, 8760
SLIPS = (3, 6, 12, 18, 24)
CREDIT = "credit_rate"
DELAY_BASES = tuple(b for b in BASES if b != "predevelopment_share")


def bases_of(technology: str) -> tuple[str, ...]:
    return (*TECH_BASES, *(ENERGY_BASES if technology in ENERGY else STORAGE_BASES), *SHARED_BASES)


def anchor_problems(anchors: DataFrame) -> DataFrame:
    """(anchor_id, problem): what keeps a registry from being used; no rows if nothing does.

    A value is missing or low exceeds high, an id stands twice, a published anchor has no source_url, the confidence isn't a
    known one, or a technology lacks an anchor it needs (anchor_id is then the missing base and technology).
    """
    low, high = F.col("value_low"), F.col("value_high")
    wrong = [
        ("needs 0 <= value_low <= value_high", ~F.coalesce((low >= 0) & (low <= high), F.lit(False))),
        ("confidence must be published or assumption", ~F.coalesce(F.col("confidence").isin("published", "assumption"), F.lit(False))),
        ("published anchor needs a source_url", (F.col("confidence") == "published") & ~F.coalesce(F.col("source_url").startswith("http"), F.lit(False))),
        ("reverify_by must be a day", F.col("reverify_by").cast("string").try_cast("date").isNull()),
    ]
    each = anchors.select("anchor_id", F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(p)) for p, bad in wrong)))).alias("problem"))
    twice = anchors.groupBy("anchor_id").count().where("count > 1").select("anchor_id", F.lit("duplicate id").alias("problem"))
    needed = [(b, t) for t in PRICED for b in bases_of(t)]
    needs = anchors.groupBy().agg(F.collect_set("anchor_id").alias("have")).select("have", F.explode(F.array(*(F.struct(F.lit(b).alias("base"), F.lit(f"{b}_{t}").alias("own")) for b, t in needed))).alias("n"))
    missing = needs.where(~F.array_contains("have", F.col("n.base")) & ~F.array_contains("have", F.col("n.own"))).select(F.col("n.own").alias("anchor_id"), F.lit("missing").alias("problem"))
    return each.unionByName(twice).unionByName(missing)


def resolved(anchors: DataFrame, as_of: str) -> DataFrame:
    """(technology, <base>): one row per technology; each base a struct of id, low, high, confidence and whether it is past its day.

    A technology's own anchor goes before the shared one; a base that it has neither of is null.
    """
    stale = F.col("reverify_by").cast("date") < F.lit(as_of).cast("date")
    entry = F.struct(F.col("anchor_id").alias("id"), F.col("value_low").cast("double").alias("low"), F.col("value_high").cast("double").alias("high"), "confidence", stale.alias("stale"))
    registry = anchors.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("anchor_id", entry))).alias("a"))
    each = registry.select("a", F.explode(F.array(*map(F.lit, PRICED))).alias("technology"))
    own = lambda b: F.coalesce(F.try_element_at("a", F.concat(F.lit(f"{b}_"), F.col("technology"))), F.try_element_at("a", F.lit(b)))
    return each.select("technology", *(own(b).alias(b) for b in (*BASES, CREDIT)))


class Rates:
    """The two ends of each base: columns of ``resolved``, or others put in their place."""

    def __init__(self, technology: Column, ends: dict[str, tuple[Column, Column]] | None = None):
        self.technology = technology
        self.ends = ends or {b: (F.col(f"{b}.low"), F.col(f"{b}.high")) for b in BASES}

    def capex(self, mw: Column) -> tuple[Column, Column]:
        return tuple(mw * v for v in self.ends["capex_per_mw"])

    def revenue(self, mw: Column) -> tuple[Column, Column]:
        """Gross, a year: energy sold, or a capacity payment per kW and month for storage."""
        sold = [mw * f * HOURS_PER_YEAR * p for f, p in zip(self.ends["capacity_factor"], self.ends["ppa_price_mwh"], strict=True)]
        paid = [mw * 1000 * p * 12 for p in self.ends["capacity_price_kw_month"]]
        return tuple(F.when(self.technology.isin(*ENERGY), s).otherwise(p) for s, p in zip(sold, paid, strict=True))

    def escalation(self, mw: Column, months: tuple[Column, Column]) -> tuple[Column, Column]:
        return tuple(c * e * m / 12 for c, e, m in zip(self.capex(mw), self.ends["construction_escalation"], months, strict=True))

    def deferral(self, mw: Column, months: tuple[Column, Column]) -> tuple[Column, Column]:
        """The present value given up when net revenue starts later; not monotone in the rate, so each end takes the extreme over both."""
        om, life, rates = (self.ends[b] for b in ("fixed_om_kw_year", "project_life_years", "carrying_rate"))
        revenue = self.revenue(mw)

        def cost(earned: Column, kept_up: Column, years: Column, rate: Column, later: Column) -> Column:
            net = F.greatest(F.lit(0.0), earned - mw * 1000 * kept_up)
            return F.when(rate <= 0, 0.0).otherwise(net * (1 - F.pow(1 + rate, -years)) / rate * (1 - F.pow(1 + rate, -(later / 12))))

        return (
            F.least(*(cost(revenue[0], om[1], life[0], r, months[0]) for r in rates)),
            F.greatest(*(cost(revenue[1], om[0], life[1], r, months[1]) for r in rates)),
        )

    def at_risk(self, mw: Column) -> tuple[Column, Column]:
        return tuple(c * s for c, s in zip(self.capex(mw), self.ends["predevelopment_share"], strict=True))

    def slip(self, mw: Column, months: Column) -> dict[str, tuple[Column, Column]]:
        """What a slip of some months costs; ``delay`` is escalation and deferral together."""
        both = (months, months)
        e, d = self.escalation(mw, both), self.deferral(mw, both)
        return {"escalation": e, "deferral_cost": d, "delay_cost": (e[0] + d[0], e[1] + d[1]), "gross_revenue_deferred": tuple(r * months / 12 for r in self.revenue(mw))}


def _whole(name: str, ends: tuple[Column, Column], when: Column | None = None) -> list[Column]:
    rounded = [F.bround(v, 0).cast("long") for v in ends]
    return [(F.when(when, v) if when is not None else v).alias(f"{name}_{end}") for v, end in zip(rounded, ("low", "high"), strict=True)]


def _used(bases: dict[str, Column], stale: bool) -> Column:
    picked = F.array_compact(F.array(*(F.when(used & (F.col(f"{b}.stale") if stale else F.lit(True)), F.col(f"{b}.id")) for b, used in bases.items())))
    return F.array_join(F.array_sort(F.array_distinct(picked)), ";")


def ledger(projects: DataFrame, anchors: DataFrame, as_of: str) -> DataFrame:
    """``projects`` as ``rules.withheld`` gives them, with the figures of those that aren't withheld.

    capex, escalation_cost, block_sunk_cost, deferred_revenue_exposure (gross, in no total), deferral_npv_cost and
    total_economic_cost, each low and high in whole dollars, and stale_anchors. A blocked project is never built and never
    earns, so it has capital at risk only. Three rows of rates meet the projects by technology.
    """
    rates = F.broadcast(resolved(anchors, as_of).withColumnRenamed("technology", "__technology"))
    rows = withheld(projects, as_of).join(rates, F.col("priced_technology") == F.col("__technology"), "left")
    r, mw = Rates(F.col("priced_technology")), F.col("mw")
    months = tuple(F.col(f"span_days_{end}") / DAYS_PER_MONTH for end in ("low", "high"))
    told, blocked = F.col("withheld_reason").isNull(), F.col("outcome") == "blocked_confirmed"
    built, lost = told & ~blocked, told & blocked
    e, d, risk = r.escalation(mw, months), r.deferral(mw, months), r.at_risk(mw)
    exposure = tuple(v * m / 12 for v, m in zip(r.revenue(mw), months, strict=True))
    total = tuple(F.when(blocked, risk[i]).otherwise(e[i] + d[i]) for i in (0, 1))
    energy = F.col("priced_technology").isin(*ENERGY)
    used = {"capex_per_mw": told, "predevelopment_share": lost} | {b: built for b in ("construction_escalation", "fixed_om_kw_year", "project_life_years", "carrying_rate")} | {b: built & energy for b in ENERGY_BASES} | {b: built & ~energy for b in STORAGE_BASES}
    figures = [("capex", r.capex(mw), told), ("escalation_cost", e, built), ("block_sunk_cost", risk, lost), ("deferred_revenue_exposure", exposure, built), ("deferral_npv_cost", d, built), ("total_economic_cost", total, told)]
    kept = [c for c in rows.columns if c not in (*BASES, CREDIT, "__technology")]
    return rows.select(*kept, *(c for f in figures for c in _whole(*f)), F.when(told, _used(used, stale=True)).alias("stale_anchors"))


def rate_card(anchors: DataFrame, as_of: str, credit: tuple[str, ...] = ()) -> DataFrame:
    """Per technology what a MW, and a month's delay of a MW, cost. The credit at a deadline for technologies in ``credit`` that have an anchor for it."""
    one, priced = F.lit(1.0), F.col("technology").isin(*credit) if credit else F.lit(False)
    rows = resolved(anchors, as_of).withColumn("__rate", F.when(priced, F.col(CREDIT)))
    r = Rates(F.col("technology"))
    slip, capex = r.slip(one, one), r.capex(one)
    per_month = {"escalation": "escalation_per_mw_month", "deferral_cost": "deferral_cost_per_mw_month", "delay_cost": "delay_cost_per_mw_month", "gross_revenue_deferred": "gross_revenue_deferred_per_mw_month"}
    energy = F.col("technology").isin(*ENERGY)
    used = {b: F.lit(True) for b in (*TECH_BASES, *SHARED_BASES)} | {b: energy for b in ENERGY_BASES} | {b: ~energy for b in STORAGE_BASES} | {CREDIT: priced}
    columns = [*_whole("capex_per_mw", capex), *(c for k, name in per_month.items() for c in _whole(name, slip[k])), *_whole("capital_at_risk_per_mw", r.at_risk(one))]
    return rows.select("technology", *columns, *_whole("credit_at_deadline_per_mw", (capex[0] * F.col("__rate.low"), capex[1] * F.col("__rate.high"))), _used(used, stale=True).alias("stale_anchors"))


def scenarios(anchors: DataFrame, as_of: str, mw: float = 100.0, slips: tuple[int, ...] = SLIPS) -> DataFrame:
    """Per technology and months of slip, what a project of ``mw`` costs."""
    rows = resolved(anchors, as_of).withColumn("slip_months", F.explode(F.array(*map(F.lit, slips))))
    slip = Rates(F.col("technology")).slip(F.lit(mw), F.col("slip_months").cast("double"))
    return rows.select("technology", F.lit(mw).alias("mw"), "slip_months", *(c for k, v in slip.items() for c in _whole(k, v)))


def anchor_sensitivity(anchors: DataFrame, as_of: str, mw: float = 100.0, months: int = 12) -> DataFrame:
    """The cost of a delay with one anchor at either end and all others at their middles, and the swing between; one at a time."""
    rows = resolved(anchors, as_of).withColumn("varied", F.explode(F.array(*map(F.lit, DELAY_BASES))))
    entry = F.coalesce(*(F.when(F.col("varied") == b, F.col(b)) for b in DELAY_BASES))
    needed = F.coalesce(*(F.when(F.col("technology") == t, F.col("varied").isin(*bases_of(t))) for t in PRICED))
    middle = {b: (F.col(f"{b}.low") + F.col(f"{b}.high")) / 2 for b in BASES}

    def delay(end: str) -> Column:
        at = {b: F.when(F.col("varied") == b, F.col(f"{b}.{end}")).otherwise(m) for b, m in middle.items()}
        return Rates(F.col("technology"), {b: (v, v) for b, v in at.items()}).slip(F.lit(mw), F.lit(float(months)))["delay_cost"][0]

    low, high = delay("low"), delay("high")
    found = rows.where(needed).select("technology", entry.alias("a"), low.alias("low"), high.alias("high"))
    whole = lambda c: F.bround(c, 0).cast("long")
    return found.select("technology", F.col("a.id").alias("anchor_id"), F.col("a.confidence").alias("confidence"), whole(F.col("low")).alias("delay_cost_at_anchor_low"), whole(F.col("high")).alias("delay_cost_at_anchor_high"), whole(F.abs(F.col("high") - F.col("low"))).alias("swing"))
