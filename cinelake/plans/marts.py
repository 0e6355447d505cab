"""The four data marts: one row per fact, described by its dimensions.

Dimensions that hang off another dimension are joined to it first, so the fact
is probed once per key it carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalars import full_name
from cinelake.operators.joins import Dim, lookup_unwind, star_join


def _named(customers: DataFrame) -> DataFrame:
    return customers.select(
        "Key", "Geography Key", full_name(F.col("First Name"), F.col("Last Name")).alias("Cliente")
    )


def _placed(customers: DataFrame, geography: DataFrame) -> DataFrame:
    return lookup_unwind(
        _named(customers), Dim(geography, "Geography Key", take={"Country": "Pais", "City": "Ciudad"})
    )


def streaming_mart(
    events: DataFrame, customers: DataFrame, geography: DataFrame, contents: DataFrame, providers: DataFrame
) -> DataFrame:
    placed = _placed(customers, geography)
    joined = star_join(
        events,
        [
            Dim(placed, "Customer Key", take={"Cliente": "Cliente", "Pais": "Pais", "Ciudad": "Ciudad"}),
            Dim(contents, "Content Key", take={"Title": "Contenido"}),
            Dim(providers, "Provider Key", take={"Name": "Proveedor"}),
        ],
    )
    return joined.select(
        F.col("Stream Event Key").alias("Evento_ID"),
        F.col("Date Key").alias("Fecha_ID"),
        "Cliente",
        "Pais",
        "Ciudad",
        "Contenido",
        "Proveedor",
        F.col("Streams Count").alias("Total_Reproducciones"),
        F.col("Minutes Watched").alias("Minutos_Vistos"),
        F.col("Watch Percentage").alias("Porcentaje_Visto"),
        F.col("Completion Flag").alias("Completado"),
    )


def payment_mart(
    payments: DataFrame, customers: DataFrame, geography: DataFrame, providers: DataFrame, plans: DataFrame
) -> DataFrame:
    placed = _placed(customers, geography)
    joined = star_join(
        payments,
        [
            Dim(placed, "Customer Key", take={"Cliente": "Cliente", "Pais": "Pais", "Ciudad": "Ciudad"}),
            Dim(providers, "Provider Key", take={"Name": "Proveedor"}),
            Dim(plans, "Subscription Plan Key", take={"Type": "Tipo_Plan"}),
        ],
    )
    return joined.select(
        F.col("Payment Key").alias("Pago_ID"),
        F.col("Date Key").alias("Fecha_ID"),
        "Cliente",
        "Pais",
        "Ciudad",
        "Proveedor",
        "Tipo_Plan",
        F.col("Amount").alias("Monto"),
        F.col("Tax Amount").alias("Impuesto"),
        F.col("Discount Amount").alias("Descuento"),
    )


def subscription_mart(
    subscriptions: DataFrame, customers: DataFrame, providers: DataFrame, plans: DataFrame
) -> DataFrame:
    joined = star_join(
        subscriptions,
        [
            Dim(_named(customers), "Customer Key", take={"Cliente": "Cliente"}),
            Dim(providers, "Provider Key", take={"Name": "Proveedor"}),
            Dim(plans, "Plan Key", take={"Type": "Tipo_Plan"}),
        ],
    )
    return joined.select(
        F.col("Subscription Fact Key").alias("Suscripcion_ID"),
        F.col("Date Key").alias("Fecha_ID"),
        "Cliente",
        "Proveedor",
        "Tipo_Plan",
        F.col("Subscription Start Date Key").alias("Fecha_Inicio_ID"),
        F.col("Subscription End Date Key").alias("Fecha_Fin_ID"),
        F.col("Is Active").alias("Activo"),
        F.col("Revenue").alias("Ingreso"),
    )


def availability_mart(availability: DataFrame, contents: DataFrame, providers: DataFrame) -> DataFrame:
    joined = star_join(
        availability,
        [
            Dim(contents, "Content Key", take={"Title": "Contenido", "Release Year": "Anio_Lanzamiento"}),
            Dim(providers, "Provider Key", take={"Name": "Proveedor", "Type": "Tipo_Proveedor"}),
        ],
    )
    return joined.select(
        F.col("Catalog Key").alias("Catalogo_ID"),
        F.col("Date Key").alias("Fecha_ID"),
        "Contenido",
        "Anio_Lanzamiento",
        "Proveedor",
        "Tipo_Proveedor",
        F.col("License Start Date Key").alias("Licencia_Inicio_ID"),
        F.col("License End Date Key").alias("Licencia_Fin_ID"),
        F.col("Is Available").alias("Disponible"),
        F.col("Catalog Rank Score").alias("Ranking_Catalogo"),
    )
