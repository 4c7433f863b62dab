"""The four revenue waterfalls as data: roles, metric terms and derived columns.

Versions: ``uf`` (by state), ``sva`` (without state), ``full`` and ``full2``. The two full tables
add recurring plans and the transfer flag and differ in their grid and in some terms; they are
separate operators and are not meant to agree.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cascata.functions import business as B
from cascata.functions import text as T
from cascata.operators.waterfall import ONE, Cube, Metric, Part, Role, Source, Waterfall
from cascata.sources.scans import snapshot

SIZED = "sized"
ACCOUNT = "advertiser_id"
DIMS = ("Canal", "Equipe", "Regiao_Macro", "Mes_Base", "Tamanho")
FLAG, STATE = "Transferencias", "UF"
UF, SVA, FULL, FULL2 = "uf", "sva", "full", "full2"
c = F.col


# ---- sources -------------------------------------------------------------------------------


def _amount(df: DataFrame, name: str) -> Column:
    """Text becomes double, null where unreadable; numbers stay as they are."""
    text = isinstance(df.schema[name].dataType, StringType)
    return c(name).try_cast("double") if text else c(name)


def revenue_rows(enriched: DataFrame) -> DataFrame:
    migrated = c("status_migrado") == B.MIGRATED
    return enriched.withColumns(
        {
            "tam": B.fold_smallest(c("tamanho_ajustado")),
            "reg": c("regionalizacao"),
            "transf": c("id_migracao_pro_field"),
            # Only migrated rows are read at the cell they left.
            "out_canal": F.when(migrated, c("aux_canal_out")),
            "out_equipe": F.when(migrated, c("coordenador_ajustado_out")),
        }
    )


def _with_blanks(rows: DataFrame, version: str) -> DataFrame:
    """Null keys by version: full2 shows them as blank, full only in its cells; the others keep null."""
    if version in (UF, SVA):
        return rows
    named = {"tam": F.coalesce("tam", F.lit("")), "transf": F.coalesce("transf", F.lit(B.NO))}
    if version == FULL2:
        named["reg"] = F.coalesce("reg", F.lit(""))
    else:
        # Metrics of full, but for its opening count, leave out cells without size or flag.
        named[SIZED] = c("tam").isNotNull() & c("transf").isNotNull()
    return rows.withColumns(named)


def plan_rows(plans: DataFrame, day: date | None = None) -> DataFrame:
    rows = snapshot(plans, day)
    cleaned = rows.withColumns(
        {
            "__channel": T.clean_upper(c("canal")),
            "__state": T.clean_upper(c("estado_conta")),
            "__city": T.clean_upper(c("cidade_conta")),
        }
    )
    person = T.clean_upper(c("coordenador_conta"))
    return cleaned.select(
        c("canal").cast("string").alias("canal"),
        B.team_of(c("__channel"), person, "ONLINE", "ND").alias("equipe"),
        B.region_of(c("__state"), c("__city")).alias("reg"),
        B.fold_smallest(c("tamanho").cast("string")).alias("tam"),
        c("competencia").cast("date").alias("competencia"),
        c("mes_churn").cast("date").alias("mes_churn"),
        c("status").cast("string").alias("status"),
        "status_recorrente",
        c("coordenador_conta").cast("string").alias("coordenador_conta"),
        _amount(rows, "valor_mensal").alias("valor"),
    )


def payment_rows(payments: DataFrame, version: str) -> DataFrame:
    text = {
        "canal": c("canal"),
        "equipe": c("coordenador_ajustado"),
        "reg": c("regionalizacao"),
        "tam": c("tamanho"),
        "transf": c("id_migracao_pro_field"),
    }
    if version == FULL2:
        blank = lambda x, default="": F.coalesce(T.strip(x), F.lit(default))
        text = {
            "canal": blank(text["canal"]),
            "equipe": blank(text["equipe"]),
            "reg": B.payment_region(text["reg"]),
            "tam": blank(text["tam"]),
            "transf": blank(text["transf"], B.NO),
        }
    return payments.select(
        *[v.alias(k) for k, v in text.items()],
        "uf",
        F.try_to_date(c("mes_pago"), "d/M/yyyy").alias("mes"),
        *[_amount(payments, a).alias(a) for a in ("antecipado", "no_mes", "transcorrido")],
    )


# ---- roles ---------------------------------------------------------------------------------


def _filled(column: str) -> str:
    return f"({column} IS NOT NULL AND {column} <> '')"


def _next(column: str) -> str:
    return f"add_months({column}, 1)"


def _quoted(text: str) -> str:
    return f"'{text}'"


def _key(version, channel, team, region, month, size, flag=None, state=None) -> dict[str, str]:
    key = dict(zip(DIMS, (channel, team, region, month, size)))
    if version in (FULL, FULL2):
        key[FLAG] = flag
    if version == UF:
        key[STATE] = state
    return key


def _revenue_roles(version: str) -> dict[str, Role]:
    def at(channel, team, month, flag="transf"):
        return _key(version, channel, team, "reg", month, "tam", flag, "estado")

    here = ("canal_conta", "coordenador_ajustado")
    left = ("out_canal", "out_equipe")
    filled = _filled("canal_conta")
    wide = version == FULL2
    roles = {
        "CUR": Role(at(*here, "mes_base"), filled),
        "NEXT": Role(at(*here, _next("mes_base")), filled if wide else None),
        "CHURN": Role(
            at(*here, "dt_cancelado"), f"{filled} AND dt_cancelado IS NOT NULL" if wide else None
        ),
        "RAW": Role(at("canal_conta", "cordenador", "mes_base")),
    }
    if version == UF:
        return roles
    if not wide:
        roles["OUT_CUR"] = Role(at(*left, "mes_base"))
        roles["OUT_CHURN"] = Role(at(*left, "dt_cancelado"))
        return roles
    # Values a cell loses are not split by transfer flag here: both flags of a cell show them.
    for flag in (B.YES, B.NO):
        own = f"{MOVED} AND transf = {_quoted(flag)}"
        roles[f"OUT_CUR:{flag}"] = Role(at(*left, "mes_base", _quoted(flag)), own)
        roles[f"OUT_CHURN:{flag}"] = Role(at(*left, "dt_cancelado", _quoted(flag)))
    return roles


def _plan_roles(version: str) -> dict[str, Role]:
    """Plans are never transfers, so they sit in the 'Não' cells only."""

    def at(month):
        return _key(version, "canal", "equipe", "reg", month, "tam", _quoted(B.NO))

    filled = _filled("canal")
    wide = version == FULL2
    return {
        "CUR": Role(at("competencia"), filled if wide else f"{filled} AND {_filled('tam')}"),
        "NEXT": Role(at(_next("competencia")), filled if wide else None),
        "CHURN": Role(at("mes_churn")),
    }


# ---- metrics -------------------------------------------------------------------------------

ANY = "TRUE"
NEW, UP, DOWN = (f"classificacao = '{v}'" for v in (B.NEW, B.UP, B.DOWN))
CHURNED, RECOVERED = (f"classificacao_churn = '{v}'" for v in (B.CHURN, B.RECOVERED))
PAID, MOVED = f"status_ts = '{B.PAID_STATUS}'", f"status_migrado = '{B.MIGRATED}'"
KEPT = "(dt_cancelado IS NULL OR dt_cancelado <> mes_base)"
BILLED, DELTA, PRICE = "faturado_mes", "delta", "valor"
PLAN_NEW, PLAN_CHURN = "status_recorrente = 'Novo'", "status_recorrente = 'Churn'"
PLAN_PAID = "status = 'PAID'"
PLAN_KEPT = "(mes_churn IS NULL OR mes_churn <> competencia)"
PLAN_KEPT_FULL2 = (
    f"{PLAN_KEPT} AND (canal NOT IN ('Online', 'ND') OR coalesce(coordenador_conta, '') = '')"
)
AT_ONCE = "mes_base = dt_cancelado"
#: Conditions that hold for a whole cell of a source or for none of its rows.
OF_CELLS = (SIZED, MOVED, KEPT, PLAN_KEPT, AT_ONCE)
# The amount test binds to the second condition only.
PLAN_PAYING = "(mes_churn IS NULL OR (mes_churn <> competencia AND valor > 0))"
# Signed in the last six calendar days and not cancelled in the same month.
LATE_DAYS = (
    "day_base > date_sub(last_day(mes_base), 6) AND day_base <= last_day(mes_base) AND "
    "(dt_cancelado IS NULL OR trunc(dt_cancelado, 'MM') <> trunc(mes_base, 'MM'))"
)


def _nonzero(*columns: str) -> str:
    return "(" + " OR ".join(f"{x} <> 0" for x in columns) + ")"


def _sum_of(*columns: str) -> str:
    return " + ".join(f"coalesce({x}, 0)" for x in columns)


def _all(*tests: str | tuple[str, ...]) -> tuple[str, ...]:
    return tuple(x for test in tests for x in (test if isinstance(test, tuple) else (test,)))


class _Spec:
    """Collects metrics of one version in output order."""

    def __init__(self, version: str):
        self.version = version
        self.full = version in (FULL, FULL2)
        self.metrics: list[Metric] = []

    def _part(self, source, role, where, value, sign, distinct=False) -> list[Part]:
        if role.startswith("OUT") and self.version == FULL2:
            roles = [f"{role}:{flag}" for flag in (B.YES, B.NO)]
        else:
            roles = [role]
        # What a cell's columns decide is not part of the sums.
        tests = _all(where)
        cell = " AND ".join(t for t in tests if t in OF_CELLS) or None
        row = " AND ".join(t for t in tests if t not in (*OF_CELLS, ANY)) or ANY
        return [Part(source, r, row, value, sign, distinct, cell) for r in roles]

    def rows(self, role, where, sign=1, sized=True):
        """Revenue rows; distinct accounts where the table counts accounts."""
        return self._part("revenue", role, self._sized(where, sized), ONE, sign, not self.full)

    def total(self, role, where, value, sign=1):
        return self._part("revenue", role, self._sized(where), value, sign)

    def _sized(self, where, sized=True):
        return _all(SIZED, where) if sized and self.version == FULL else where

    def plans(self, role, where, value=ONE, sign=1):
        return self._part("plans", role, where, value, sign) if self.full else []

    def payments(self, where, value=ONE):
        return self._part("payments", "CUR", where, value, 1)

    def add(self, name, *groups):
        self.metrics.append(Metric(name, tuple(p for g in groups for p in g)))


def _opening(s: _Spec) -> None:
    wide = s.version == FULL2
    moves = []
    if s.full:
        moves = [s.rows("CUR", MOVED, sized=False), s.rows("OUT_CUR", MOVED, -1, sized=False)]
    plan_rule = PLAN_KEPT_FULL2 if wide else PLAN_KEPT
    s.add("base_inicial_qtd", s.rows("NEXT", KEPT, sized=False), *moves, s.plans("NEXT", plan_rule))
    s.add("novos_qtd", s.rows("CUR", NEW), s.plans("CUR", PLAN_NEW))
    s.add("churn_qtd", s.rows("CHURN", CHURNED, -1), s.plans("CHURN", PLAN_CHURN, ONE, -1))
    billed = _all(KEPT, "faturado_mes > 0") if wide else KEPT
    plan_billed = PLAN_PAYING if wide else PLAN_KEPT
    s.add("base_inicial_valor", s.total("NEXT", billed, BILLED), s.plans("NEXT", plan_billed, PRICE))
    s.add("novos_valor", s.total("CUR", NEW, BILLED), s.plans("CUR", PLAN_NEW, PRICE))
    s.add("up_valor", s.total("CUR", UP, DELTA))
    s.add("down_valor", s.total("CUR", DOWN, DELTA))
    s.add(
        "churn_valor", s.total("CHURN", CHURNED, BILLED, -1), s.plans("CHURN", PLAN_CHURN, PRICE, -1)
    )
    s.add("recuperados_valor", s.total("CUR", RECOVERED, BILLED))
    s.add("recuperados_novos_valor", s.total("CUR", _all(RECOVERED, NEW), BILLED))


def _addons_and_payments(s: _Spec) -> None:
    vip, top = "faturado_mes_bairro_vip", "faturado_mes_topo_fixo"
    s.add("campanha_qtd", s.rows("CUR", _nonzero("faturado_mes_campanha")))
    s.add("campanha_valor", s.total("CUR", ANY, "faturado_mes_campanha"))
    s.add("sva_qtd", s.rows("CUR", _nonzero(vip, top)))
    s.add("sva_valor", s.total("CUR", ANY, _sum_of(vip, top)))
    kinds = {"adiantados": "antecipado", "no_mes": "no_mes", "transcorridos": "transcorrido"}
    for name, column in kinds.items():
        plans = s.plans("CUR", PLAN_PAID, PRICE) if name == "no_mes" else []
        s.add(f"pagamentos_{name}_valor", s.payments(ANY, column), plans)
    s.add("pagamento_campanha_valor", s.total("CUR", ANY, "pago_mes_campanha"))
    s.add("pagamento_sva_valor", s.total("CUR", ANY, _sum_of("pago_mes_bairro", "pago_mes_topo")))
    for name, column in kinds.items():
        plans = s.plans("CUR", PLAN_PAID) if name == "no_mes" else []
        s.add(f"pagamentos_{name}_qtd", s.payments(_nonzero(column)), plans)
    s.add("pagamento_campanha_qtd", s.total("RAW", ANY, "apoio_qtd_campanha"))
    s.add("pagamento_sva_qtd", s.total("RAW", ANY, "apoio_qtd_sva"))
    s.add("up_qtd", s.rows("CUR", UP))
    s.add("down_qtd", s.rows("CUR", DOWN))


def _paid_only(s: _Spec) -> None:
    if s.version == FULL2:
        plans = [s.plans("NEXT", PLAN_PAYING, PRICE)]
    else:
        same_month = "status_recorrente IN ('flat', 'Churn')"
        plans = [s.plans("CUR", same_month, PRICE), s.plans("CHURN", PLAN_CHURN, PRICE)]
    s.add("base_inicial_pago_valor", s.total("NEXT", _all(PAID, KEPT), BILLED), *plans)
    s.add("novos_pago_valor", s.total("CUR", _all(PAID, NEW), BILLED), s.plans("CUR", PLAN_NEW, PRICE))
    s.add("up_pago_valor", s.total("CUR", _all(PAID, UP), DELTA))
    s.add("down_pago_valor", s.total("CUR", _all(PAID, DOWN), DELTA))
    s.add(
        "churn_pago_valor",
        s.total("CHURN", _all(PAID, CHURNED), BILLED, -1),
        s.plans("CHURN", PLAN_CHURN, PRICE, -1),
    )
    s.add("recuperados_pago_valor", s.total("CUR", _all(PAID, RECOVERED), BILLED))
    s.add("recuperados_novos_pago_valor", s.total("CUR", _all(PAID, RECOVERED, NEW), BILLED))


def _migration(s: _Spec) -> None:
    """Moves counted at the cell entered (in) and at the cell left (out)."""
    for side, prefix in (("in", ""), ("out", "OUT_")):
        now, gone = f"{prefix}CUR", f"{prefix}CHURN"
        churned = _all(CHURNED, MOVED)
        s.add(f"churn_migracao_{side}_qtd", s.rows(gone, churned, -1))
        s.add(f"up_migracao_{side}_qtd", s.rows(now, _all(UP, MOVED)))
        s.add(f"down_migracao_{side}_qtd", s.rows(now, _all(DOWN, MOVED)))
        s.add(f"churn_migracao_{side}_valor", s.total(gone, churned, BILLED, -1))
        s.add(f"up_migracao_{side}_valor", s.total(now, _all(UP, MOVED), DELTA))
        s.add(f"down_migracao_{side}_valor", s.total(now, _all(DOWN, MOVED), DELTA))
        s.add(f"base_migracao_{side}_valor", s.total(now, MOVED, BILLED))
        s.add(f"base_migracao_{side}_qtd", s.rows(now, MOVED))


def _full_only(s: _Spec) -> None:
    at_once = _all(CHURNED, MOVED, AT_ONCE)
    for side, role in (("in", "CHURN"), ("out", "OUT_CHURN")):
        s.add(f"churn_{side}_bi_qtd", s.rows(role, at_once, -1))
        s.add(f"churn_{side}_bi_valor", s.total(role, at_once, BILLED, -1))
    if s.version == FULL2:
        stored = "volume_transcorrido"
        s.add(f"{stored}_valor", s.total("NEXT", ANY, stored))
        s.add(f"{stored}_qtd", s.rows("NEXT", f"{stored} > 0"))
    else:
        s.add("volume_transcorrido_valor", s.total("NEXT", LATE_DAYS, BILLED))
        s.add("volume_transcorrido_qtd", s.rows("NEXT", LATE_DAYS))


def metrics(version: str) -> list[Metric]:
    s = _Spec(version)
    _opening(s)
    _addons_and_payments(s)
    _paid_only(s)
    if version != UF:
        _migration(s)
    if s.full:
        _full_only(s)
    return s.metrics


# ---- tables --------------------------------------------------------------------------------


def _upper_team(roles: dict[str, Role]) -> dict[str, Role]:
    """Team keys upper-cased and trimmed, so spellings of one team meet in one cell."""
    upper = lambda key: {**key, "Equipe": f"upper(trim({key['Equipe']}))"}
    return {name: Role(upper(role.key), role.grid) for name, role in roles.items()}


#: Columns that any version's cells are made of.
CUBE_GROUP = (
    "canal_conta", "coordenador_ajustado", "cordenador", "reg", "tam", "mes_base", "dt_cancelado",
    "transf", "estado", "out_canal", "out_equipe", "status_migrado",
)
VERSIONS = (UF, SVA, FULL, FULL2)


def cube_of(sums: DataFrame | None = None, ids: DataFrame | None = None) -> Cube:
    """The contributions of revenue rows to all four waterfalls, from stored ``sums`` and ``ids``."""
    parts = [
        p for v in VERSIONS for m in metrics(v) for p in m.parts if p.source == "revenue"
    ]
    return Cube(parts, "revenue", CUBE_GROUP, sums, ids)


def revenue_sums(enriched: DataFrame) -> DataFrame:
    """All sums of revenue rows by cell; for a stored table, see ``cube_of``."""
    return cube_of().sums_of(revenue_rows(enriched))


def revenue_ids(enriched: DataFrame) -> DataFrame:
    """The accounts of each cell with the conditions they meet."""
    return cube_of().ids_of(revenue_rows(enriched), ACCOUNT)


def _revenue_source(version, enriched, cube, fix) -> Source:
    roles = fix(_revenue_roles(version))
    if cube is not None:
        sums, ids = _with_blanks(cube.sums, version), _with_blanks(cube.ids, version)
        group = [*CUBE_GROUP, SIZED] if version == FULL else CUBE_GROUP
        return Source(sums, roles, group, id=ACCOUNT, cube=cube, id_frame=ids)
    group = [g for g in CUBE_GROUP if g not in ("transf", "estado", "out_canal", "out_equipe", "status_migrado")]
    group += ["transf"] if version in (FULL, FULL2) else []
    group += ["estado"] if version == UF else []
    group += ["out_canal", "out_equipe", "status_migrado"] if version != UF else []
    group += [SIZED] if version == FULL else []
    return Source(_with_blanks(revenue_rows(enriched), version), roles, group, id=ACCOUNT)


def _cells(version, enriched, payments=None, plans=None, normalize_keys=False, with_metrics=True, cube=None, day=None):
    dims = list(DIMS)
    dims += [FLAG] if version in (FULL, FULL2) else []
    dims += [STATE] if version == UF else []
    fix = _upper_team if normalize_keys else (lambda roles: roles)
    sources = {"revenue": _revenue_source(version, enriched, cube, fix)}
    if payments is not None:
        key = _key(version, "canal", "equipe", "reg", "mes", "tam", "transf", "uf")
        shared = ["canal", "equipe", "reg", "mes", "tam", *(["transf"] if FLAG in dims else [])]
        sources["payments"] = Source(
            payment_rows(payments, version), fix({"CUR": Role(key)}),
            [*shared, *(["uf"] if version == UF else [])],
        )
    if plans is not None:
        sources["plans"] = Source(
            plan_rows(plans, day), fix(_plan_roles(version)),
            ["canal", "equipe", "reg", "tam", "competencia", "mes_churn"],
        )
    return Waterfall(dims, metrics(version) if with_metrics else [], sources).build()


def _placed(cells: DataFrame) -> DataFrame:
    return cells.where(c("Regiao_Macro").isNotNull() & T.is_filled(c("Equipe")))


def _team_key() -> Column:
    return T.join_key(c("Canal"), c("Equipe"))


def grid(version: str, enriched: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """The distinct cells of a table without its metrics."""
    cells = _cells(version, enriched, plans=plans, with_metrics=False)
    if version in (FULL, FULL2):
        return cells
    return _placed(cells).where(T.is_filled(c(STATE))) if version == UF else _placed(cells)


def bd_planos_uf(
    enriched: DataFrame | None, payments: DataFrame, normalize_keys: bool = False, cube: Cube | None = None
) -> DataFrame:
    """With a ``cube`` the enriched rows are not read; so in the other three tables.

    The two full tables take the ``day`` of the latest plan snapshot, where it is known.
    """
    cells = _placed(_cells(UF, enriched, payments, normalize_keys=normalize_keys, cube=cube))
    return cells.where(T.is_filled(c(STATE))).withColumn("chave_equipe_coordenador", _team_key())


def bd_planos_mensais_sva(
    enriched: DataFrame | None, payments: DataFrame, normalize_keys: bool = False, cube: Cube | None = None
) -> DataFrame:
    return _placed(_cells(SVA, enriched, payments, normalize_keys=normalize_keys, cube=cube))


def _cancelled_paid() -> Column:
    return -c("churn_pago_valor") + c("recuperados_pago_valor")


def bd_full(
    enriched: DataFrame | None,
    payments: DataFrame,
    plans: DataFrame,
    normalize_keys: bool = False,
    cube: Cube | None = None,
    day: date | None = None,
) -> DataFrame:
    cells = _cells(FULL, enriched, payments, plans, normalize_keys, cube=cube, day=day)
    return cells.withColumns(
        {
            "cancelamento_total_pago_valor": _cancelled_paid(),
            "chave_equipe_coordenador": _team_key(),
        }
    )


def bd_full_v2(
    enriched: DataFrame | None,
    payments: DataFrame,
    plans: DataFrame,
    normalize_keys: bool = False,
    cube: Cube | None = None,
    day: date | None = None,
) -> DataFrame:
    cells = _cells(FULL2, enriched, payments, plans, normalize_keys, cube=cube, day=day)
    flow = c("novos_valor") + c("up_valor") + c("down_valor") + c("churn_valor")
    flow_paid = sum((c(f"{m}_pago_valor") for m in ("novos", "up", "down", "churn")), F.lit(0))
    moved_value = c("base_migracao_in_valor") - c("base_migracao_out_valor")
    # The opening count already holds the moves; the closing count adds them again.
    moved_rows = c("base_migracao_in_qtd") - c("base_migracao_out_qtd")
    return cells.withColumns(
        {
            "base_final_valor": c("base_inicial_valor") + flow + moved_value,
            "chave_equipe_coordenador": _team_key(),
            "base_final_pago_valor": c("base_inicial_pago_valor") + flow_paid,
            "base_final_qtd": c("base_inicial_qtd") + c("novos_qtd") + c("churn_qtd") + moved_rows,
            "cancelamento_total_valor": c("churn_valor") + c("recuperados_valor"),
            "cancelamento_total_pago_valor": _cancelled_paid(),
        }
    )
