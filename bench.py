"""Times every derived table from stored source tables; prints one JSON line.

Sources are written once, untimed, with the declared types. Each table is then built and fully
computed from its stored inputs three times, and the best time counts (the first run also compiles).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from cascata import schemas, session
from cascata.plans import crm, daily, grids, payments, recurring, revenue
from checks import fixtures as X

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SOURCES = {
    "gold": schemas.GOLD,
    "silver_cb": schemas.SILVER_CB,
    "paids": schemas.PAYMENTS,
    "planos": schemas.PLANS,
    "radar": schemas.RADAR,
    "opportunity": schemas.OPPORTUNITY,
    "account": schemas.ACCOUNT,
    "crm_user": schemas.USER,
}


def store(spark, folder):
    for name, schema in SOURCES.items():
        frame = schemas.conform(X.view(spark, FOLDER, name), schema)
        writer = frame.write.mode("overwrite")
        (writer.partitionBy("dt") if "dt" in frame.columns else writer).parquet(f"{folder}/{name}")
    return {n: spark.read.schema(s).parquet(f"{folder}/{n}") for n, s in SOURCES.items()}


def tables(f):
    """Builders in chain order; the enriched and payment tables are stored before their users."""
    return {
        "receita_consolidada": lambda: revenue.receita_consolidada(f["gold"], f["silver_cb"]),
        "desconto_faseado": lambda: crm.desconto_faseado(
            f["opportunity"], f["account"], f["crm_user"], f["gold"], X.AS_OF
        ),
        "radar_cohort": lambda: crm.radar_cohort(f["radar"]),
        "cb_pagamentos": lambda: payments.cb_pagamentos(
            f["gold"], f["paids"], X.AS_OF, X.TRANSFER_SINCE, unique_months=True
        ),
        "receita_enriquecida": lambda: revenue.receita_enriquecida(
            f["gold"], f["desconto_faseado"], f["radar_cohort"], unique_months=True
        ),
        "receita_enriquecida_split": lambda: revenue.receita_enriquecida(
            f["gold"], f["desconto_faseado"], f["radar_cohort"]
        ),
        # The two tables that the four waterfalls roll up from.
        "receita_celulas": lambda: grids.revenue_sums(f["receita_enriquecida"]),
        "receita_celulas_contas": lambda: grids.revenue_ids(f["receita_enriquecida"]),
        "bd_planos_uf": lambda: grids.bd_planos_uf(None, f["cb_pagamentos"], cube=cube(f)),
        "bd_planos_mensais_sva": lambda: grids.bd_planos_mensais_sva(
            None, f["cb_pagamentos"], cube=cube(f)
        ),
        "planos_periodicos": lambda: recurring.planos_periodicos(f["planos"], bounded=True),
        "bd_planos_periodicos": lambda: recurring.bd_planos_periodicos(f["planos"], bounded=True),
        "bd_full": lambda: grids.bd_full(None, f["cb_pagamentos"], f["planos"], cube=cube(f)),
        "bd_full_v2": lambda: grids.bd_full_v2(None, f["cb_pagamentos"], f["planos"], cube=cube(f)),
        "diarizacao": lambda: daily.diarizacao(f["receita_enriquecida"]),
        "transferencias": lambda: revenue.transferencias(f["receita_enriquecida"]),
        "tamanhos_ajustados": lambda: revenue.tamanhos_ajustados(
            f["receita_enriquecida"], unique_months=True
        ),
    }


def cube(f):
    return grids.cube_of(f["receita_celulas"], f["receita_celulas_contas"])


def others(f):
    """The waterfalls straight from the enriched rows, and tables without the statement that months are unique."""
    paid, rows = f["cb_pagamentos"], f["receita_enriquecida"]
    return {
        "bd_planos_uf_direct": lambda: grids.bd_planos_uf(rows, paid),
        "bd_planos_mensais_sva_direct": lambda: grids.bd_planos_mensais_sva(rows, paid),
        "bd_full_direct": lambda: grids.bd_full(rows, paid, f["planos"]),
        "bd_full_v2_direct": lambda: grids.bd_full_v2(rows, paid, f["planos"]),
        "cb_pagamentos_split": lambda: payments.cb_pagamentos(f["gold"], f["paids"], X.AS_OF, X.TRANSFER_SINCE),
        "planos_periodicos_split": lambda: recurring.planos_periodicos(f["planos"]),
        "bd_planos_periodicos_split": lambda: recurring.bd_planos_periodicos(f["planos"]),
        "tamanhos_ajustados_split": lambda: revenue.tamanhos_ajustados(rows),
    }


STORED = (
    "desconto_faseado", "radar_cohort", "cb_pagamentos", "receita_enriquecida", "receita_celulas", "receita_celulas_contas",
)


def best_of(build) -> float:
    times = []
    for _ in range(RUNS):
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.time() - start)
    return round(min(times), 3)


def main() -> None:
    spark = session.build(
        f"local[{CPUS}]", "cascata-bench", **{"spark.sql.shuffle.partitions": CPUS}
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    start = time.time()
    frames = store(spark, folder)
    prepared = time.time() - start
    seconds = {}
    for name, build in tables(frames).items():
        seconds[name] = best_of(build)
        if name in STORED:
            build().write.mode("overwrite").parquet(f"{folder}/{name}")
            frames[name] = spark.read.parquet(f"{folder}/{name}")
    print(
        json.dumps(
            {
                "metric": "derived_tables_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "not_in_total": {name: best_of(build) for name, build in others(frames).items()},
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "prepare_sec": round(prepared, 3),
                "gold_rows": frames["gold"].count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
