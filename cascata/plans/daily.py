"""Daily pivot of new, cancelled, raised and lowered revenue by channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.functions import business as B
from cascata.operators.pivot import PivotClass, dated_pivot

CHANNELS = ("Field", "Inside", "Online", "ND")  # fixed values: pivot columns
CLASSES = (
    PivotClass("novo", "day_base", "classificacao", B.NEW, "faturado_mes"),
    PivotClass("churn", "day_churn", "classificacao_churn", B.CHURN, "faturado_mes"),
    PivotClass("upgrade", "day_base", "classificacao", B.UP, "delta"),
    PivotClass("downgrade", "day_base", "classificacao", B.DOWN, "delta"),
)


def diarizacao(enriched: DataFrame) -> DataFrame:
    pivot = dated_pivot(enriched, CLASSES, "canal_conta", CHANNELS, "Mes")
    return pivot.withColumn("dia_numero", F.day("Mes"))
