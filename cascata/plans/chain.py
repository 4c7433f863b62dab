"""The derived tables in order, with their inputs, and a runner that stores each one."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.operators import quality
from cascata.plans import crm, daily, grids, payments, recurring, revenue
from cascata.sources import modes, scans, sinks, versions
from cascata.sources.ledger import SKIPPED, Ledger

DONE, FAILED, BLOCKED = "done", "failed", "blocked"
#: A table or a run that a quality check turned down.
REFUSED = "refused"
GATE, EXPORT = "quality_gate", "export"
Check = Callable[[DataFrame], DataFrame]


class Frames(dict[str, DataFrame]):
    """Frames by name, with the newest snapshot day of those whose folders tell it.

    ``revenue_day`` is the one snapshot of gold and silver to read; None reads all their rows.
    """

    def __init__(self, frames=(), days: dict | None = None, revenue_day: date | None = None):
        super().__init__(frames)
        self.days, self.revenue_day = days or {}, revenue_day

    def day(self, name: str):
        return self.days.get(name)

    def cube(self):
        return grids.cube_of(self[SUMS], self[IDS])



@dataclass(frozen=True)
class Step:
    name: str
    order: int
    inputs: tuple[str, ...]
    build: Callable[[Frames, date], DataFrame]
    scheduled: bool = True
    shown_by: tuple[str, ...] = ()  # display order; a stored table keeps none
    helper: bool = False  # stored for other tables, no report of its own


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    error: str = ""


GOLD, SILVER, PLANS, PAIDS = "gold", "silver_cb", "planos", "paids"
SUMS, IDS = "receita_celulas", "receita_celulas_contas"
CELL_ORDER = ("-Mes_Base", "Canal", "Equipe")

STEPS = (
    Step(
        "desconto_faseado", 0, ("opportunity", "account", "crm_user", GOLD),
        lambda f, day: crm.desconto_faseado(
            f["opportunity"], f["account"], f["crm_user"], f[GOLD], day, f.day("opportunity"), f.day(GOLD)
        ),
    ),
    Step("radar_cohort", 0, ("radar",), lambda f, day: crm.radar_cohort(f["radar"], f.day("radar"))),
    Step(
        "receita_consolidada", 1, (GOLD, SILVER),
        lambda f, day: revenue.receita_consolidada(f[GOLD], f[SILVER], f.revenue_day),
    ),
    Step(
        "cb_pagamentos", 2, (GOLD, PAIDS),
        lambda f, day: payments.cb_pagamentos(
            f[GOLD], f[PAIDS], day, snapshot=f.revenue_day, paid_day=f.day(PAIDS)
        ),
        shown_by=("-mes_pago", "advertiser_id"),
    ),
    Step(
        "receita_enriquecida", 3, (GOLD, "desconto_faseado", "radar_cohort"),
        lambda f, day: revenue.receita_enriquecida(
            f[GOLD], f["desconto_faseado"], f["radar_cohort"], snapshot=f.revenue_day
        ),
    ),
    # The four waterfalls roll up from these two; the enriched rows are read for them alone.
    Step(
        SUMS, 3, ("receita_enriquecida",), lambda f, day: grids.revenue_sums(f["receita_enriquecida"]), helper=True
    ),
    Step(
        IDS, 3, ("receita_enriquecida",), lambda f, day: grids.revenue_ids(f["receita_enriquecida"]), helper=True
    ),
    Step(
        "bd_planos_uf", 4, (SUMS, IDS, "cb_pagamentos"),
        lambda f, day: grids.bd_planos_uf(None, f["cb_pagamentos"], cube=f.cube()),
        shown_by=(*CELL_ORDER, "UF"),
    ),
    Step(
        "bd_planos_mensais_sva", 5, (SUMS, IDS, "cb_pagamentos"),
        lambda f, day: grids.bd_planos_mensais_sva(None, f["cb_pagamentos"], cube=f.cube()),
        shown_by=CELL_ORDER,
    ),
    Step(
        "planos_periodicos", 6, (PLANS,),
        lambda f, day: recurring.planos_periodicos(f[PLANS], day=f.day(PLANS)),
    ),
    Step(
        "bd_planos_periodicos", 7, (PLANS,),
        lambda f, day: recurring.bd_planos_periodicos(f[PLANS], day=f.day(PLANS)), shown_by=CELL_ORDER,
    ),
    Step(
        "bd_full", 8, (SUMS, IDS, "cb_pagamentos", PLANS),
        lambda f, day: grids.bd_full(None, f["cb_pagamentos"], f[PLANS], cube=f.cube(), day=f.day(PLANS)),
        shown_by=CELL_ORDER,
    ),
    Step(
        "diarizacao", 9, ("receita_enriquecida",),
        lambda f, day: daily.diarizacao(f["receita_enriquecida"]), shown_by=("-Mes",),
    ),
    Step(
        "bd_full_v2", 10, (SUMS, IDS, "cb_pagamentos", PLANS),
        lambda f, day: grids.bd_full_v2(None, f["cb_pagamentos"], f[PLANS], cube=f.cube(), day=f.day(PLANS)),
        scheduled=False, shown_by=CELL_ORDER,
    ),
    Step(
        "transferencias", 11, ("receita_enriquecida",),
        lambda f, day: revenue.transferencias(f["receita_enriquecida"]),
        scheduled=False, shown_by=("-mes_base", "advertiser_id"),
    ),
    Step(
        "tamanhos_ajustados", 12, ("receita_enriquecida",),
        lambda f, day: revenue.tamanhos_ajustados(f["receita_enriquecida"]),
        scheduled=False, shown_by=("advertiser_id", "mes_base"),
    ),
)


def display(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Sort for display; a leading '-' sorts descending, day/month/year text sorts as a date."""
    keys = []
    for name in columns:
        bare = name.lstrip("-")
        c = F.col(bare)
        if bare == "mes_pago":
            c = F.try_to_date(c, "dd/MM/yyyy")
        keys.append(c.desc() if name.startswith("-") else c.asc())
    return df.orderBy(*keys)


def _failures(check: Check) -> Callable[[DataFrame], list[str]]:
    """Messages of the checks (see ``quality``) that a written table does not pass."""
    return lambda stored: [r["message"] for r in check(stored).where("not passed").collect()]


def run_chain(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    folder: str,
    as_of: date,
    steps: Iterable[Step] = STEPS,
    scheduled_only: bool = True,
    checks: dict[str, Check] | None = None,
) -> list[Outcome]:
    """Build and store the tables in order.

    A failed table does not stop the others; tables that need it are marked blocked. Each stored
    table is read back for its dependants, which ends its lineage in shared storage. A table is
    replaced only when it is wholly written and passes its check: one that fails, is refused or is
    blocked keeps the rows of the run before.
    """
    frames = sources if isinstance(sources, Frames) else Frames(sources)
    frames, outcomes = Frames(frames, frames.days, frames.revenue_day), []
    for step in sorted(steps, key=lambda s: s.order):
        if scheduled_only and not step.scheduled:
            continue
        missing = [n for n in step.inputs if n not in frames]
        if missing:
            outcomes.append(Outcome(step.name, BLOCKED, f"no {', '.join(missing)}"))
            continue
        path = f"{folder.rstrip('/')}/{step.name}"
        check = (checks or {}).get(step.name)
        try:
            with sinks.scratch(spark):
                sinks.overwrite(step.build(frames, as_of), path, check=_failures(check) if check else None)
            frames[step.name] = versions.read(spark, path)
            outcomes.append(Outcome(step.name, DONE))
        except versions.Refused as e:
            outcomes.append(Outcome(step.name, REFUSED, "; ".join(e.failures)))
        except Exception as e:  # driver and executor errors alike
            outcomes.append(Outcome(step.name, FAILED, f"{type(e).__name__}: {e}"))
    return outcomes


def stored_frames(
    spark: SparkSession, tables: Iterable[modes.SourceTable], folder: str, one_snapshot: bool = False
) -> Frames:
    """Stored source tables, with the newest days that their folder names tell.

    ``one_snapshot`` reads gold and silver at the newest day of gold alone.
    """
    frames, days = {}, {}
    for table in tables:
        path = f"{folder.rstrip('/')}/{table.name}"
        frames[table.name] = versions.read(spark, path)
        by_day = scans.newest_partition(spark, path) if table.partition == "dt" else scans.newest_day_folder(spark, path)
        if by_day is not None:
            days[table.name] = by_day
    return Frames(frames, days, days.get(GOLD) if one_snapshot else None)


def run_group(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    tables: Iterable[modes.SourceTable],
    folder: str,
    ledger: Ledger,
    as_of: date,
    group: str = modes.ALL,
    month: str | None = None,
    steps: Iterable[Step] = STEPS,
    checks: dict[str, Check] | None = None,
    gate: dict[str, Callable[[Frames], DataFrame]] | None = None,
    exports: Iterable[str] = (),
    one_snapshot: bool = False,
) -> list[Outcome]:
    """Load the source tables of a cadence, then build the derived tables from all stored ones.

    A source that fails stops no other; derived tables that need it are blocked, so none is built on
    yesterday's rows unseen. Sources of other cadences, and those without new rows, are taken as an
    earlier load left them. A month bootstrap loads historical tables and builds nothing.

    After the tables the quality ``gate`` runs: named checks of all frames, whose failures are reported and
    change nothing. Then the tables of ``exports`` that this run built are written as CSV below
    ``exports/``; one that was not built is blocked, one without rows is skipped.
    """
    tables, outcomes, failed = list(tables), [], set()
    base = folder.rstrip("/")
    for table in modes.in_group(tables, group):
        try:
            status = modes.load(spark, sources[table.name], table, base, ledger, as_of, month)
            kept = status in (SKIPPED, modes.NOT_HISTORICAL)
            outcomes.append(Outcome(table.name, status if kept else DONE))
        except Exception as e:  # driver and executor errors alike
            failed.add(table.name)
            outcomes.append(Outcome(table.name, FAILED, f"{type(e).__name__}: {e}"))
    if month:
        return outcomes
    held = [t for t in tables if t.name not in failed and not ledger.is_first_load(t.name)]
    frames = stored_frames(spark, held, base, one_snapshot)
    built = run_chain(spark, frames, base, as_of, steps, checks=checks)
    done = [o.name for o in built if o.status == DONE]
    for name in done:
        frames[name] = versions.read(spark, f"{base}/{name}")
    if gate:
        passed, failures = quality.run_gate({n: (lambda make=make: make(frames)) for n, make in gate.items()})
        built.append(Outcome(GATE, DONE if passed else REFUSED, "; ".join(failures)))
    for name in exports:
        built.append(_exported(frames, name, name in done, f"{base}/exports/{name}"))
    return outcomes + built


def _exported(frames: Frames, name: str, built: bool, path: str) -> Outcome:
    label = f"{EXPORT}:{name}"
    if not built:
        return Outcome(label, BLOCKED, f"no {name}")
    try:
        return Outcome(label, DONE if sinks.export_csv(frames[name], path) else SKIPPED)
    except Exception as e:  # driver and executor errors alike
        return Outcome(label, FAILED, f"{type(e).__name__}: {e}")
