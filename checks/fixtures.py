"""Inputs of the checks: revenue-like views on the given tables.

Each text runs unchanged on Spark and on the checking engine. They stand for source tables; the
library does not use them.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2000, 6, 15)
TRANSFER_SINCE = date(1999, 1, 1)

VIEWS = {
    "gold": """
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_base, MIN(CAST(o_orderdate AS DATE)) AS day_base,
 MIN(o_orderkey) AS k, MAX(o_orderstatus) AS st, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS fat FROM orders GROUP BY 1,2),
l AS (SELECT m.*, o_custkey%29 AS b, LAG(fat) OVER (PARTITION BY o_custkey ORDER BY mes_base) AS pf FROM m)
SELECT CAST(o_custkey AS STRING) AS advertiser_id, mes_base, CASE b%4 WHEN 0 THEN 'P' WHEN 1 THEN 'PP' WHEN 2 THEN 'M' END AS tamanho,
 CASE b%7 WHEN 0 THEN 'Insercao 50' WHEN 1 THEN 'Plano livre' WHEN 2 THEN NULL WHEN 3 THEN 'Plano 20' WHEN 4 THEN 'Plano 80' WHEN 5 THEN 'Plano 600' ELSE 'Plano 900' END AS pacote,
 split_part('RS,SC,PR,MG,ES,RJ,MS,MT,GO,DF,TO,PA,AP,RO,AC,AM,BA,PI,MA,CE,RN,PB,PE,AL,SE,SP,RR,sp , ', ',', CAST(b+1 AS INT)) AS estado, CASE o_custkey%3 WHEN 0 THEN 'São Paulo' WHEN 1 THEN 'Campinas' END AS municipio, mes_base AS ultimo_mes_pagamento,
 CASE WHEN st='F' THEN '1-Paid' ELSE '2-Open' END AS status_ts, fat AS faturado_mes,
 CASE WHEN pf IS NULL THEN 'Novo' WHEN k%7=0 THEN 'Flat' WHEN fat>pf THEN 'Upgrade' ELSE 'Downgrade' END AS classificacao,
 CASE WHEN k%6=0 THEN 'CHURN' WHEN k%6=1 THEN 'CHURN - Recuperado' END AS classificacao_churn,
 CASE WHEN k%6=0 THEN CASE WHEN k%4=0 THEN mes_base ELSE CAST(mes_base + INTERVAL 1 MONTH AS DATE) END END AS dt_cancelado,
 fat-pf AS delta, day_base, CASE WHEN k%6=0 THEN CAST(day_base + INTERVAL 3 DAY AS DATE) END AS day_churn,
 CASE k%8 WHEN 0 THEN CAST(fat*0.1 AS DECIMAL(18,2)) WHEN 1 THEN CAST(0 AS DECIMAL(18,2)) END AS faturado_mes_campanha,
 CASE k%8 WHEN 0 THEN CAST(fat*0.05 AS DECIMAL(18,2)) WHEN 1 THEN CAST(0 AS DECIMAL(18,2)) END AS pago_mes_campanha,
 CASE WHEN k%9=0 THEN CAST(fat*0.02 AS DECIMAL(18,2)) END AS faturado_mes_bairro_vip, CASE WHEN k%9=0 THEN CAST(fat*0.01 AS DECIMAL(18,2)) END AS pago_mes_bairro,
 CASE WHEN k%10=0 THEN CAST(fat*0.03 AS DECIMAL(18,2)) END AS faturado_mes_topo_fixo, CASE WHEN k%10=0 THEN CAST(fat*0.01 AS DECIMAL(18,2)) END AS pago_mes_topo,
 CASE k%4 WHEN 0 THEN 'Field' WHEN 1 THEN 'Inside' WHEN 2 THEN 'Online' ELSE 'ND' END AS canal_conta,
 CASE b%5 WHEN 0 THEN '' WHEN 1 THEN ' ana souza ' WHEN 2 THEN NULL WHEN 3 THEN 'BRUNO' ELSE 'CARLA' END AS cordenador, DATE '2001-08-01' AS dt FROM l
""",
    "silver_cb": """
SELECT advertiser_id, tamanho, pacote, estado, municipio, mes_base, status_ts, CAST(faturado_mes*0.9 AS DECIMAL(18,2)) AS pago_mes, classificacao, canal_conta, cordenador AS dono_conta, dt FROM gold
""",
    "paids": """
SELECT CAST(o_custkey AS STRING) AS advertiser_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes_pago, CASE WHEN l_linestatus='F' THEN '1-Paid' ELSE '2-Open' END AS status_ts,
 CAST(SUM(CASE WHEN l_returnflag='A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS antecipado,
 CAST(SUM(CASE WHEN l_returnflag='N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS no_mes,
 CAST(SUM(CASE WHEN l_returnflag='R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS transcorrido,
 MAX(CAST(l_shipdate AS DATE)) AS day_paid, CASE WHEN l_linenumber=7 THEN DATE '2001-07-01' ELSE DATE '2001-08-01' END AS dt
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY 1,2,3,8
""",
    "planos": """
WITH g AS (SELECT o_custkey AS id_conta_olx, l_suppkey%3 AS id_contrato, CAST(date_trunc('month', l_shipdate) AS DATE) AS competencia,
 CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS valor_mensal, MIN(l_linestatus) AS ls, MIN(l_linenumber) AS ln, MAX(l_partkey) AS pk FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY 1,2,3)
SELECT id_conta_olx, id_contrato, competencia, valor_mensal, CASE WHEN ls='F' THEN 'PAID' ELSE 'OPEN' END AS status,
 CASE ln%3 WHEN 0 THEN 'Novo' WHEN 1 THEN 'Churn' ELSE 'flat' END AS status_recorrente,
 CASE WHEN ln%3=1 THEN CASE WHEN pk%2=0 THEN competencia ELSE CAST(competencia + INTERVAL 1 MONTH AS DATE) END END AS mes_churn,
 CASE WHEN pk%11=0 THEN 'livre' ELSE CONCAT('Pacote ', CAST((pk*37)%900 AS STRING), ' x') END AS package_name,
 CASE pk%5 WHEN 0 THEN 'PP' WHEN 1 THEN 'P' WHEN 2 THEN 'M' WHEN 3 THEN '' END AS tamanho,
 CASE id_conta_olx%5 WHEN 0 THEN 'Field' WHEN 1 THEN 'Inside' WHEN 2 THEN 'Online' WHEN 3 THEN 'ND' ELSE '' END AS canal,
 CASE id_conta_olx%4 WHEN 0 THEN 'bruno' WHEN 1 THEN ' Carla ' WHEN 2 THEN '' END AS coordenador_conta,
 split_part('RS,SC,PR,MG,ES,RJ,MS,MT,GO,DF,TO,PA,AP,RO,AC,AM,BA,PI,MA,CE,RN,PB,PE,AL,SE,SP,RR,sp , ', ',', CAST(id_conta_olx%29+1 AS INT)) AS estado_conta, CASE id_conta_olx%3 WHEN 0 THEN 'são paulo' WHEN 1 THEN 'Campinas' END AS cidade_conta,
 CASE WHEN ln=7 THEN DATE '2001-07-01' ELSE DATE '2001-08-01' END AS dt FROM g
""",
    "radar": """
SELECT CAST(o_custkey AS STRING) AS advertiser_id, CASE WHEN MIN(o_orderkey)%50=0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) + INTERVAL 10 DAY AS DATE) END AS base_date,
 CAST(date_trunc('month', o_orderdate) + INTERVAL 20 DAY AS DATE) AS expiration_date,
 CASE MIN(o_orderkey)%3 WHEN 0 THEN NULL WHEN 1 THEN CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) ELSE CAST(date_trunc('month', o_orderdate) + INTERVAL 25 DAY AS DATE) END AS payment_date,
 DATE '2001-08-01' AS dt FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate)
""",
    "opportunity": """
SELECT CAST(o_custkey AS STRING) AS accountid, CASE WHEN o_orderkey%10=0 THEN 'nobody' ELSE CAST(o_custkey%(SELECT MAX(s_suppkey)+1 FROM supplier) AS STRING) END AS ownerid, o_orderpriority AS stagename, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
 CASE o_orderkey%6 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '0.0' WHEN 3 THEN '15.5' ELSE '100' END AS discountrecurringvalue__c, CAST(o_orderkey AS STRING) AS uniqueopportunityidentifier__c,
 2001 AS year, CASE WHEN o_orderkey%10=0 THEN 7 ELSE 8 END AS month, 1 AS day FROM orders
""",
    "account": """
SELECT CAST(c_custkey AS STRING) AS id, CASE WHEN c_custkey%10=0 THEN '' WHEN c_custkey%10=1 THEN NULL WHEN c_custkey%10=2 THEN CONCAT('x', CAST(c_custkey AS STRING)) ELSE CAST(c_custkey AS STRING) END AS idorigin__c, c_name AS name, 2001 AS year, 8 AS month, 1 AS day FROM customer
""",
    "crm_user": """
SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name, 2001 AS year, 8 AS month, 1 AS day FROM supplier
""",
}
BASE_TABLES = {
    "gold": ("orders",),
    "paids": ("lineitem", "orders"),
    "planos": ("lineitem", "orders"),
    "radar": ("orders",),
    "opportunity": ("orders", "supplier"),
    "account": ("customer",),
    "crm_user": ("supplier",),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One fixture view over the tables of a folder."""
    if name == "silver_cb":
        tables = {"gold": view(spark, folder, "gold")}
    else:
        tables = {t: table(spark, folder, t) for t in BASE_TABLES[name]}
    text = VIEWS[name]
    for t in tables:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **tables)


def with_views(*names: str) -> str:
    """The views as a WITH list for the checking engine."""
    wanted = ["gold", *names] if "silver_cb" in names and "gold" not in names else list(names)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in VIEWS if n in wanted]
    return "WITH " + ",\n".join(parts)
