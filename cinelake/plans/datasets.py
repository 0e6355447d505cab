"""Published datasets: what each report is called outside, and in which order it is listed.

A layout is a table of columns. One select takes them from the report under their
published names; incomplete and repeated rows go, and the rows are sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``columns``: (name in the report, published name) in order; all as they are if there are none.
    ``falling`` is sorted first, largest value on top, then the columns of ``rising``."""

    columns: tuple[tuple[str, str], ...] = ()
    falling: str | None = None
    rising: tuple[str, ...] = ()
    repeats: bool = False

    def __call__(self, report: DataFrame) -> DataFrame:
        chosen = report.select(*[F.col(f"`{name}`").alias(public) for name, public in self.columns] or ["*"])
        whole = chosen.na.drop("any")
        rows = whole if self.repeats else whole.dropDuplicates()
        order = [F.desc(self.falling)] if self.falling else []
        order += [F.asc(name) for name in self.rising]
        return rows.orderBy(*order) if order else rows


# Report columns and the published names, in the published order.
inactive_subscribers = Layout(
    (
        ("Key", "Cliente_ID"), ("First Name", "Nombre"), ("Last Name", "Apellido"), ("Email", "Correo"),
        ("Gender", "Genero"), ("Geography Key", "Geografia_ID"), ("Is Active", "Cliente_Activo"),
        ("Create Date", "Fecha_Registro"),
    ),
    rising=("Cliente_ID",),
)
content_profitability = Layout(
    (
        ("Titulo", "Contenido"), ("Total_Streams", "Total_Reproducciones"), ("Total_Eventos", "Total_Eventos_Streaming"),
        ("Total_Minutos", "Total_Minutos_Vistos"), ("Revenue", "Ingreso_Total"), ("Ingreso_por_Stream", "Indice_Rentabilidad"),
    ),
    falling="Indice_Rentabilidad", rising=("Contenido",), repeats=True,
)
views_by_country_category = Layout(
    (
        ("Pais", "Pais"), ("Categoria", "Categoria_Contenido"), ("Total_Visualizaciones", "Total_Visualizaciones"),
        ("Total_Eventos", "Total_Eventos_Streaming"), ("Total_Minutos", "Total_Minutos_Vistos"),
    ),
    falling="Total_Visualizaciones", rising=("Pais", "Categoria_Contenido"),
)
top_customer_providers = Layout(
    (
        ("Cliente", "Nombre_Cliente"), ("Servidor", "Plataforma"), ("Total_Eventos", "Total_Eventos_Streaming"),
        ("Total_Streams", "Total_Reproducciones"),
    ),
    falling="Total_Eventos_Streaming", rising=("Nombre_Cliente", "Plataforma"),
)
income_by_city = Layout(
    (
        ("Pais", "Pais"), ("Ciudad", "Ciudad"), ("Ingreso_Total", "Ingreso_Total_Suscriptores"),
        ("Total_Pagos", "Total_Pagos_Registrados"), ("Total_Impuestos", "Total_Impuestos"),
        ("Total_Descuentos", "Total_Descuentos"),
    ),
    falling="Ingreso_Total_Suscriptores", rising=("Pais", "Ciudad"),
)
mart = Layout()  # data marts have their published names already
