"""Reports, marts and their published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cinelake.plans import registry
from cinelake.sources.retail_star import RetailStar
from conformance import case
from conformance.star_sql import with_tables

Q1 = """
SELECT * FROM cust WHERE "Is Active" AND NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = "Key" AND o_orderdate IN (
    SELECT DISTINCT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 30))"""

Q2 = """
SELECT l_partkey AS "Content Key", "Title" AS "Titulo", "Revenue", "Total_Streams", "Total_Eventos",
       "Total_Minutos", CAST("Revenue" AS DOUBLE) / nullif("Total_Streams", 0) AS "Ingreso_por_Stream"
FROM (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS "Total_Streams", count(*) AS "Total_Eventos",
             CAST(sum(floor(l_extendedprice)) AS BIGINT) AS "Total_Minutos"
      FROM lineitem GROUP BY l_partkey)
JOIN content ON "Key" = l_partkey"""

Q3 = """
SELECT g."Country" AS "Pais", t."Name" AS "Categoria",
       CAST(sum(e."Streams Count") AS BIGINT) AS "Total_Visualizaciones", count(*) AS "Total_Eventos",
       CAST(sum(e."Minutes Watched") AS BIGINT) AS "Total_Minutos"
FROM event e JOIN cust c ON e."Customer Key" = c."Key" JOIN geography g ON c."Geography Key" = g."Key"
JOIN bridge b ON e."Content Key" = b."Content Key" JOIN category t ON b."Category Key" = t."Key"
GROUP BY 1, 2"""

Q4 = """
SELECT "First Name" || ' ' || "Last Name" AS "Cliente", p."Name" AS "Servidor", "Total_Eventos", "Total_Streams"
FROM (SELECT "Customer Key" AS ck, "Provider Key" AS pk, count(*) AS "Total_Eventos",
             CAST(sum("Streams Count") AS BIGINT) AS "Total_Streams"
      FROM event GROUP BY 1, 2)
JOIN cust c ON ck = c."Key" JOIN provider p ON pk = p."Key"
ORDER BY "Total_Eventos" DESC, "Total_Streams" DESC, ck, pk LIMIT 20"""

Q5 = """
SELECT g."Country" AS "Pais", g."City" AS "Ciudad", round_even(sum("Amount"), 2) AS "Ingreso_Total",
       count(*) AS "Total_Pagos", round_even(sum("Tax Amount"), 2) AS "Total_Impuestos",
       round_even(sum("Discount Amount"), 2) AS "Total_Descuentos"
FROM payment JOIN cust c ON "Customer Key" = c."Key" JOIN geography g ON c."Geography Key" = g."Key"
GROUP BY 1, 2"""

Q6 = """
SELECT "Stream Event Key" AS "Evento_ID", "Date Key" AS "Fecha_ID",
       "First Name" || ' ' || "Last Name" AS "Cliente", "Country" AS "Pais", "City" AS "Ciudad",
       "Title" AS "Contenido", p."Name" AS "Proveedor", "Streams Count" AS "Total_Reproducciones",
       "Minutes Watched" AS "Minutos_Vistos", "Watch Percentage" AS "Porcentaje_Visto",
       "Completion Flag" AS "Completado"
FROM event JOIN cust c ON "Customer Key" = c."Key" JOIN geography g ON "Geography Key" = g."Key"
JOIN content t ON "Content Key" = t."Key" JOIN provider p ON "Provider Key" = p."Key\""""

Q7 = """
SELECT "Payment Key" AS "Pago_ID", "Date Key" AS "Fecha_ID", "First Name" || ' ' || "Last Name" AS "Cliente",
       "Country" AS "Pais", "City" AS "Ciudad", p."Name" AS "Proveedor", l."Type" AS "Tipo_Plan",
       "Amount" AS "Monto", "Tax Amount" AS "Impuesto", "Discount Amount" AS "Descuento"
FROM payment JOIN cust c ON "Customer Key" = c."Key" JOIN geography g ON "Geography Key" = g."Key"
JOIN provider p ON "Provider Key" = p."Key" JOIN plan l ON "Subscription Plan Key" = l."Key\""""

Q8 = """
SELECT "Subscription Fact Key" AS "Suscripcion_ID", "Date Key" AS "Fecha_ID",
       "First Name" || ' ' || "Last Name" AS "Cliente", p."Name" AS "Proveedor", l."Type" AS "Tipo_Plan",
       "Subscription Start Date Key" AS "Fecha_Inicio_ID", "Subscription End Date Key" AS "Fecha_Fin_ID",
       s."Is Active" AS "Activo", "Revenue" AS "Ingreso"
FROM subscription s JOIN cust c ON "Customer Key" = c."Key"
JOIN provider p ON "Provider Key" = p."Key" JOIN plan l ON "Plan Key" = l."Key\""""

Q9 = """
SELECT "Catalog Key" AS "Catalogo_ID", "Date Key" AS "Fecha_ID", "Title" AS "Contenido",
       "Release Year" AS "Anio_Lanzamiento", p."Name" AS "Proveedor", "Type" AS "Tipo_Proveedor",
       "License Start Date Key" AS "Licencia_Inicio_ID", "License End Date Key" AS "Licencia_Fin_ID",
       "Is Available" AS "Disponible", "Catalog Rank Score" AS "Ranking_Catalogo"
FROM availability JOIN content t ON "Content Key" = t."Key" JOIN provider p ON "Provider Key" = p."Key\""""

Q1_TABLES = "cust"
Q2_TABLES = "content"
Q3_TABLES = "event cust geography bridge category"
Q4_TABLES = "event cust provider"
Q5_TABLES = "payment cust geography"
Q6_TABLES = "event cust geography content provider"
Q7_TABLES = "payment cust geography provider plan"
Q8_TABLES = "subscription cust provider plan"
Q9_TABLES = "availability content provider"


def _dataset(tables: str, body: str, select: str, distinct: bool = True) -> str:
    return with_tables(tables, f"SELECT {'DISTINCT ' if distinct else ''}{select} FROM ({body})")


D1 = _dataset(Q1_TABLES, Q1, """"Key" AS "Cliente_ID", "First Name" AS "Nombre", "Last Name" AS "Apellido",
    "Email" AS "Correo", "Gender" AS "Genero", "Geography Key" AS "Geografia_ID",
    "Is Active" AS "Cliente_Activo", "Create Date" AS "Fecha_Registro\"""")
D2 = _dataset(Q2_TABLES, Q2, """"Titulo" AS "Contenido", "Total_Streams" AS "Total_Reproducciones",
    "Total_Eventos" AS "Total_Eventos_Streaming", "Total_Minutos" AS "Total_Minutos_Vistos",
    "Revenue" AS "Ingreso_Total", "Ingreso_por_Stream" AS "Indice_Rentabilidad\"""", distinct=False)
D3 = _dataset(Q3_TABLES, Q3, """"Pais", "Categoria" AS "Categoria_Contenido", "Total_Visualizaciones",
    "Total_Eventos" AS "Total_Eventos_Streaming", "Total_Minutos" AS "Total_Minutos_Vistos\"""")
D4 = _dataset(Q4_TABLES, Q4, """"Cliente" AS "Nombre_Cliente", "Servidor" AS "Plataforma",
    "Total_Eventos" AS "Total_Eventos_Streaming", "Total_Streams" AS "Total_Reproducciones\"""")
D5 = _dataset(Q5_TABLES, Q5, """"Pais", "Ciudad", "Ingreso_Total" AS "Ingreso_Total_Suscriptores",
    "Total_Pagos" AS "Total_Pagos_Registrados", "Total_Impuestos", "Total_Descuentos\"""")
D6 = _dataset(Q6_TABLES, Q6, "*")
D7 = _dataset(Q7_TABLES, Q7, "*")
D8 = _dataset(Q8_TABLES, Q8, "*")
D9 = _dataset(Q9_TABLES, Q9, "*")


SQLS = {
    "inactive_subscribers": (Q1_TABLES, Q1, D1),
    "content_profitability": (Q2_TABLES, Q2, D2),
    "views_by_country_category": (Q3_TABLES, Q3, D3),
    "top_customer_providers": (Q4_TABLES, Q4, D4),
    "income_by_city": (Q5_TABLES, Q5, D5),
    "streaming_mart": (Q6_TABLES, Q6, D6),
    "payment_mart": (Q7_TABLES, Q7, D7),
    "subscription_mart": (Q8_TABLES, Q8, D8),
    "availability_mart": (Q9_TABLES, Q9, D9),
}


def _register(number: int, name: str) -> None:
    tables, sql, dataset_sql = SQLS[name]

    @case(f"q{number}_{name}", with_tables(tables, sql))
    def query(spark, directory) -> DataFrame:
        return registry.QUERIES[name](RetailStar(spark, directory))

    @case(f"dataset_{number}_{name}", dataset_sql)
    def published(spark, directory) -> DataFrame:
        return registry.dataset(name, RetailStar(spark, directory))


for _number, _name in enumerate(registry.QUERIES, start=1):
    _register(_number, _name)
