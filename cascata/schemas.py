"""Declared schemas of the source tables; production reads never infer types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as P
from pyspark.sql.types import StructField, StructType

TYPES = {
    "string": P.StringType(),
    "date": P.DateType(),
    "double": P.DoubleType(),
    "bigint": P.LongType(),
    "int": P.IntegerType(),
    "timestamp": P.TimestampType(),
}


def declare(columns: str, nullable: bool = True) -> StructType:
    """'name type, name type' as a schema; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, TYPES[kind], nullable) for name, kind in pairs])


GOLD = declare(
    "advertiser_id string, mes_base date, tamanho string, pacote string, estado string, "
    "municipio string, ultimo_mes_pagamento date, status_ts string, faturado_mes double, "
    "classificacao string, classificacao_rec string, classificacao_churn string, "
    "vigencia_bt string, dt_cancelado date, delta double, day_base date, day_churn date, "
    "faturado_mes_campanha double, status_ts_campanha string, pago_mes_campanha double, "
    "faturado_mes_bairro_vip double, status_ts_bairro_vip string, pago_mes_bairro double, "
    "faturado_mes_topo_fixo double, status_ts_topo_fixo string, pago_mes_topo double, "
    "total_faturado_sva double, total_pago_sva double, canal_conta string, dono_conta string, "
    "dt date, cordenador string, advertiser_industry string"
)
SILVER_CB = declare(
    "advertiser_id string, mes_base date, tamanho string, pacote string, estado string, "
    "municipio string, status_ts string, pago_mes double, classificacao string, "
    "canal_conta string, dono_conta string, dt date"
)
PLANS = declare(
    "id_conta_olx bigint, id_contrato bigint, dono_conta string, dono_contrato string, "
    "competencia date, valor_total double, valor_mensal double, data_inicio date, "
    "data_termino date, status string, status_recorrente string, periodicidade string, "
    "method string, channel string, mes_churn date, dt date, package_name string, "
    "tamanho string, coordenador_conta string, canal string, estado_conta string, "
    "cidade_conta string, nome_da_conta string, email_conta string, "
    "documento_da_conta string, advertiser_industry string"
)
PAYMENTS = declare(
    "advertiser_id string, mes_pago date, status_ts string, antecipado double, no_mes double, "
    "transcorrido double, pago_mes double, day_paid date, dt date"
)
OPPORTUNITY = declare(
    "accountid string, ownerid string, lastmodifieddate timestamp, stagename string, "
    "amount double, recurringtotalvalue__c double, discountrecurringvalue__c string, "
    "uniqueopportunityidentifier__c string, leadsource string, generatedby__c string, "
    "discountrecurringpercentage__c double, year int, month int, day int"
)
ACCOUNT = declare(
    "id string, idorigin__c string, name string, year int, month int, day int"
)
USER = declare("id string, name string, year int, month int, day int")
RADAR = declare(
    "advertiser_id string, base_date date, expiration_date date, payment_date date, dt date"
)


def complete(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns first, in order; absent ones as typed nulls. Present types are kept."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    declared = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*declared, *extra)


def drift(df: DataFrame, schema: StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, found type) of every difference; 'absent' marks a missing side."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*declared, *(n for n in found if n not in declared)]
    pairs = [(n, declared.get(n, "absent"), found.get(n, "absent")) for n in names]
    return [p for p in pairs if p[1] != p[2]]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the declared types; unreadable values become null."""
    full = complete(df, schema)
    return full.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def unreadable(field: StructField) -> Column:
    """A value is there that ``conform`` cannot read."""
    return F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()


def guard(df: DataFrame, schema: StructType, lossy: bool = False) -> DataFrame:
    """As ``conform``, but columns not declared stay and an unreadable value fails the job unless ``lossy``."""
    full = complete(df, schema)
    read = {}
    for f in schema.fields:
        value, message = F.col(f.name).try_cast(f.dataType), F.concat(
            F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(f.name).cast("string")
        )
        failed = F.when(unreadable(f), F.raise_error(message).cast(f.dataType)).otherwise(value)
        read[f.name] = value if lossy else failed
    return full.withColumns(read)


def lost_values(df: DataFrame, schema: StructType) -> DataFrame:
    """Per declared column the number of values that ``conform`` cannot read."""
    present = [f for f in schema.fields if f.name in df.columns]
    counts = df.agg(
        *[
            F.count_if(unreadable(f)).alias(f.name)
            for f in present
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("lost")) for f in present]
    )
    return counts.select(F.inline(pairs))
