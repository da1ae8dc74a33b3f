"""Rules that raise alerts, their versions and their calibration."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import normalized
from .asof import as_of
from .orderstats import with_percentiles

# Fixed values of the splitting rule: tiers of ceilings with the multiple of the ceiling that fires.
TIERS = ((Decimal(50_000_000), Decimal("2.91")), (Decimal(120_000_000), Decimal("1.95")))
LAST_TIER = Decimal("1.42")
LEAST_CONTRACTS, CREDIBLE = 5, 20
# From which state a rule may go to which.
MOVES = {"draft": {"calibration", "retired"}, "calibration": {"active", "draft", "retired"}, "active": {"retired", "calibration"}, "retired": set()}


def plain(value) -> str | int | bool | None | list | dict:
    """A threshold or trigger in the one form that identities are made from: decimals without trailing zeros, ISO dates."""
    if isinstance(value, Decimal):
        text = f"{value:f}"
        return (text.rstrip("0").rstrip(".") if "." in text else text) or "0"
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, float):
        raise TypeError("floats have no exact form; use Decimal")
    return value


def digest(value) -> str:
    return hashlib.sha256(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


@dataclass(frozen=True)
class Rule:
    """A rule with its versions of thresholds. Every change gives a new object."""

    name: str
    state: str = "draft"
    versions: tuple[tuple[int, str], ...] = ()
    thresholds: Mapping = field(default_factory=dict)
    calibrated: int | None = None

    def with_thresholds(self, thresholds: Mapping) -> Rule:
        """A new version; thresholds that any version already has are refused."""
        mark = digest(thresholds)
        if any(mark == m for _, m in self.versions):
            raise ValueError("these thresholds are those of an earlier version")
        return replace(self, versions=(*self.versions, (len(self.versions) + 1, mark)), thresholds=dict(thresholds), calibrated=None)

    def calibrated_on(self, evaluated: int) -> Rule:
        if self.state != "calibration" or evaluated < 1:
            raise ValueError("a rule is calibrated in that state and on a sample with rows")
        return replace(self, calibrated=evaluated)

    def move(self, state: str) -> Rule:
        if state not in MOVES[self.state]:
            raise ValueError(f"{self.state} does not lead to {state}")
        if state == "active" and not self.calibrated:
            raise ValueError("only a calibrated version becomes active")
        return replace(self, state=state)


def alert_id(record: Column, dataset: str, rule: str, version: int, triggers: Column) -> Column:
    """The same for the same record, rule version and triggers, whenever it is computed."""
    parts = F.struct(F.lit(dataset).alias("dataset"), triggers.alias("disparadores"), record.alias("registro"), F.lit(rule).alias("regla"), F.lit(version).alias("version"))
    return F.sha2(F.to_json(parts), 256)


def small_contracts(contracts: DataFrame, processes: DataFrame, modality: str = "%m_nima cuant_a%") -> DataFrame:
    """Dated, possible contracts of an identified supplier under the small-value modality."""
    kind = processes.where(F.col("modality").ilike(modality)).select("process_id")
    fit = contracts.where((F.col("provisional") == F.lit(False)) & ~F.coalesce("out_of_scale", F.lit(False)) & (F.col("value") > 0) & F.col("signed_on").isNotNull())
    return fit.join(kind, "process_id", "left_semi")


def splitting_groups(small: DataFrame) -> DataFrame:
    """Contracts by entity, supplier and month with the entity's ceiling (its largest), 95th percentile and count."""
    ceilings = with_percentiles(small, ["entity_id"], "value", {"p95": 0.95}, F.max("value").alias("ceiling"), F.count(F.lit(1)).alias("entity_contracts"))
    by = ["entity_id", "supplier_type", "supplier_number"]
    ids = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), F.col("contract_id").alias("i")))), lambda x: x["i"])
    groups = small.groupBy(*by, F.trunc("signed_on", "month").alias("month")).agg(F.count(F.lit(1)).alias("contracts"), F.sum("value").alias("total"), ids.alias("ids"))
    return groups.join(ceilings, "entity_id")


def splitting_verdict(groups: DataFrame, tiers=TIERS, last=LAST_TIER, least: int = LEAST_CONTRACTS, credible: int = CREDIBLE) -> DataFrame:
    """groups with times (total by ceiling), verdict and reason.

    blind: the entity's ceiling is no credible one (none, or credible times the
    95th percentile or more) or it has too few contracts; it says nothing, and
    is not the same as quiet. fires: two or more contracts whose total is above
    the tier's multiple of the ceiling.
    """
    ceiling, p95 = F.col("ceiling").cast("double"), F.col("p95")
    unsound = ceiling.isNull() | (ceiling <= 0) | p95.isNull() | (p95 <= 0) | (ceiling / p95 >= credible)
    reason = F.when(unsound, "ceiling not credible").when(F.col("entity_contracts") < least, "too few contracts")
    multiple = F.lit(float(last))
    for edge, cut in reversed(tiers):
        multiple = F.when(ceiling < float(edge), float(cut)).otherwise(multiple)
    times = F.when(ceiling > 0, F.col("total").cast("double") / ceiling)
    out = groups.withColumn("times", times).withColumn("reason", reason)
    fires = (F.col("contracts") >= 2) & (F.col("times") > multiple)
    return out.withColumn("verdict", F.when(F.col("reason").isNotNull(), "blind").when(fires, "fires").otherwise("quiet"))


def single_bidder(processes: DataFrame, competitive: list[str]) -> DataFrame:
    """Awarded competitive processes with at most one supplier (none included, unknown not)."""
    names = [n.upper() for n in competitive]
    return processes.where(F.col("awarded") & normalized(F.col("modality")).isin(*names) & (F.col("bidders") <= 1))


def calibration(verdicts: DataFrame, by: str | None = None) -> DataFrame:
    """evaluated, fired, blind and the rate by group or overall; the rate is null where nothing was evaluated, and blind rows never count."""
    rows = verdicts.groupBy(*([by] if by else [])).agg(
        F.count_if(F.col("verdict") != "blind").alias("evaluated"), F.count_if(F.col("verdict") == "fires").alias("fired"), F.count_if(F.col("verdict") == "blind").alias("blind")
    )
    return rows.withColumn("rate", F.when(F.col("evaluated") > 0, F.col("fired") / F.col("evaluated")))


# What an alert has to show.
EVIDENCE = ("record", "dataset", "rule", "version", "threshold", "triggers", "seen_at")


def missing_evidence(alerts: DataFrame, fields: tuple[str, ...] = EVIDENCE) -> DataFrame:
    """alerts with missing, the sorted names of what they do not show: null or blank fields, and versions below 1."""
    kinds = dict(alerts.dtypes)
    lacks = lambda f: F.col(f).isNull() | ((F.trim(f) == "") if kinds[f] == "string" else F.lit(False)) | ((F.col(f) < 1) if f == "version" else F.lit(False))
    named = F.array_compact(F.array(*(F.when(lacks(f), F.lit(f)) for f in fields)))
    return alerts.withColumn("missing", F.array_join(F.array_sort(named), ", "))


def sustained(alerts: DataFrame, fields: tuple[str, ...] = EVIDENCE) -> DataFrame:
    """The alerts whose evidence is complete; the others do not exist."""
    return missing_evidence(alerts, fields).where("missing = ''").drop("missing")


def normative(ceilings: DataFrame) -> DataFrame:
    """Ceilings (concept, scope, value, unit, effective_on, source) with until, the day from which the next one holds.

    One without a concept, a scope or a source cannot be defended and is an error.
    """
    from pyspark.sql import Window

    whole = F.least(*(F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("concept", "scope", "source"))) > 0
    checked = ceilings.withColumn("value", F.when(whole, F.col("value")).otherwise(F.raise_error(F.lit("a ceiling needs a concept, a scope and a source"))))
    return checked.withColumn("until", F.lead("effective_on").over(Window.partitionBy("concept", "scope").orderBy("effective_on")))


def with_ceiling(df: DataFrame, ceilings: DataFrame, concept: str, scope: str, on: str) -> DataFrame:
    """df with ceiling, the one of its scope that held on its day; null where none did. Ceilings without a concept, scope or source are an error."""
    held = normative(ceilings.where(F.col("concept") == concept)).select(F.col("scope").alias(scope), F.col("effective_on").alias("__from"), F.col("value").alias("ceiling"))
    return as_of(df, held, [scope], on, "__from", ["ceiling"], slice="year")


def calibration_sample(alerts: DataFrame, n: int = 25) -> DataFrame:
    """The first n alerts by identity: as good as random, and the same each time."""
    return alerts.orderBy("alert_id").limit(n)


def dominant(alerts: DataFrame, by: str) -> DataFrame:
    """The group with most alerts and whether it has over half of them."""
    groups = alerts.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.max_by(by, F.struct("n", by)).alias(by), F.max("n").alias("alerts"), (2 * F.max("n") > F.sum("n")).alias("dominates"))
